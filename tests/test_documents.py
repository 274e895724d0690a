import os
import random

import pytest
from pyspark.sql import functions as F

from chondria.plans import documents as D

KINDS = "id long, name string, size int"


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root.removeprefix("file://")) for f in names if f.endswith(".parquet")}


def brute(stored, incoming, operation):
    """{id: fields} after the newest row of each incoming id is written, failing ones left out."""
    out = {i: {"name": n, "size": s} for i, n, s in stored}
    for i, name, version in sorted(incoming, key=lambda r: r[2]):
        last = max(v for j, _, v in incoming if j == i) == version
        known = any(i == j for j, _, _ in stored)
        if not last or (operation == "create" and known) or (operation == "update" and not known):
            continue
        old = {"name": None, "size": None} if operation == "index" or not known else out[i]
        out[i] = old | {"name": name, "version": version}
    return {i: (d["name"], d["size"], d.get("version")) for i, d in out.items()}


@pytest.mark.parametrize("operation", ["index", "create", "update", "upsert"])
def test_merges_of_repeated_ids(spark, tmp_path, operation):
    rng, root = random.Random(operation), f"file://{tmp_path}/store"
    stored = [(i, f"n{i}", i) for i in range(0, 400, 2)]
    incoming = [(rng.choice([4, 5, 6, 7, 100, 101]), rng.choice([None, "x", "y"]), v) for v in range(40)]
    D.write_store(spark.createDataFrame(stored, KINDS), root, "id", buckets=16)
    before = files(root)
    new = spark.createDataFrame(incoming, "id long, name string, version int")
    touched = D.merge_store(spark, root, new, "id", operation, order="version", ignore_errors=True)
    assert 0 < touched <= 6 and {f: t for f, t in files(root).items() if f in before} == before         # other files keep their time stamp
    got = {r["id"]: (r["name"], r["size"], r["version"]) for r in D.read_store(spark, root).collect()}
    assert got == brute(stored, incoming, operation)
    assert D.read_store(spark, root).count() == len(got)


def test_a_failing_merge_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], KINDS)
    D.write_store(docs, root, "id", buckets=4)
    with pytest.raises(Exception, match="exists"):
        D.merge_store(spark, root, docs, "id", "create")
    with pytest.raises(Exception, match="comes twice"):
        D.merge_store(spark, root, docs.unionByName(docs), "id", "upsert")
    with pytest.raises(Exception, match="does not exist"):
        D.merge_store(spark, root, docs.withColumn("id", F.col("id") + 9), "id", "update")
    with pytest.raises(FileExistsError):
        D.write_store(docs, root, "id")
    assert sorted(tuple(r) for r in D.read_store(spark, root).collect()) == [(1, "a", 1), (2, "b", 2)]
    assert D.merge_store(spark, root, docs.limit(0), "id") == 0
    assert D.merge_store(spark, root, spark.createDataFrame([(3, "c", 3)], KINDS), "id", "create") == 1
    assert D.merge_store(spark, root, spark.createDataFrame([(3, "d", None)], KINDS), "id", "upsert") == 1
    assert sorted(tuple(r) for r in D.read_store(spark, root).collect()) == [(1, "a", 1), (2, "b", 2), (3, "d", None)]
    with pytest.raises(ValueError, match="no document table"):
        D.read_store(spark, f"file://{tmp_path}/none")
