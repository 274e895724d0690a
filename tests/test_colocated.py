import os
import re

import pytest
from pyspark.sql import functions as F

from chondria.operators import annotate, matrix as M
from chondria.registry import QUERIES
from chondria.registry.inputs import SCHEMAS
from chondria.sinks import colocated as S
from chondria.sinks.tables import read_matrix

CALL = "s string, pos int, ref string, alt string, DP int, HL double, MQ double, TLOD double, FT array<string>"


def tables(spark, root, n=40, buckets=8):
    calls = [(f"S{i % 7}", i * 3 % 50, "A", "CG"[i % 2], i * 9, None if i % 5 == 0 else i / n, 50.0, 9.5, ["PASS"]) for i in range(n)]
    calls = list({(r[0], r[1], r[3]): r for r in calls}.values())
    coverage = [(f"S{s}", p, None if (s + p) % 11 == 0 else s * p * 7) for s in range(9) for p in range(0, 50, 2)]
    return (S.write_colocated(spark.createDataFrame(calls, CALL), f"{root}/calls", buckets=buckets),
            S.write_colocated(spark.createDataFrame(coverage, "s string, pos int, coverage int"), f"{root}/coverage", buckets=buckets))


def stored_sites(spark, calls, root):
    calls.select(*M.SITE).distinct().write.mode("overwrite").parquet(f"{root}/sites")
    return spark.read.parquet(f"{root}/sites")


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]


def test_hom_refs_without_an_exchange(spark, tmp_path):
    calls, coverage = tables(spark, str(tmp_path))
    sites = stored_sites(spark, calls, str(tmp_path))
    got = M.resolve_hom_refs(calls, coverage, sites=sites)
    moved = exchanges(got)
    assert len(moved) == 1 and "hashpartitioning(pos#" in moved[0]        # the sites, before their broadcast
    plain = M.resolve_hom_refs(spark.read.parquet(f"{tmp_path}/calls"), spark.read.parquet(f"{tmp_path}/coverage"), sites=sites)
    assert len(exchanges(plain)) == 3
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.count() > 100
    assert exchanges(coverage.groupBy("s", "pos").agg(F.sum("coverage"))) == []


def test_a_hot_sample_fills_no_bucket(spark, tmp_path):
    """A third of all rows are one sample's."""
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("s"),
                                     F.col("id").cast("int").alias("pos"), F.lit(1).alias("coverage"))
    stored = S.write_colocated(rows, str(tmp_path / "t"), buckets=8)
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)


def test_missing_and_repeated_keys(spark, tmp_path):
    """Calls without a sample or position stay and meet nothing, a missing allele is one; a coverage row adds the sites of its position but the called ones."""
    calls = spark.createDataFrame([("a", 5, "A", "C", 9, 0.5, 1.0, 1.0, None), (None, 5, "A", "G", 9, 0.5, 1.0, 1.0, None), ("a", None, "A", "C", 9, 0.5, 1.0, 1.0, None),
                                   ("b", 6, None, "C", 9, None, 1.0, 1.0, ["x"])], CALL)
    coverage = spark.createDataFrame([("a", 5, 300), ("b", 5, None), ("b", 6, 200), ("c", 7, 900), (None, 5, 400), ("a", None, 7)], "s string, pos int, coverage int")
    got = sorted((tuple(r) for r in M.resolve_hom_refs(calls, coverage).select("s", "pos", "ref", "alt", "HL", "DP").collect()), key=str)
    assert got == sorted([("a", 5, "A", "C", 0.5, 9), ("a", 5, "A", "G", 0.0, 300), ("b", 5, "A", "C", None, None), ("b", 5, "A", "G", None, None),
                          (None, 5, "A", "G", 0.5, 9), (None, 5, "A", "C", 0.0, 400), (None, 5, "A", "G", 0.0, 400), ("a", None, "A", "C", 0.5, 9),
                          ("b", 6, None, "C", 0.0, 200)], key=str)


def test_without_broadcast_the_result_is_the_same(spark, tmp_path):
    """Beyond the bound of a broadcast the sites are met by a shuffle."""
    calls, coverage = tables(spark, str(tmp_path))
    sites = stored_sites(spark, calls, str(tmp_path))
    want = sorted(map(str, M.resolve_hom_refs(calls, coverage, sites=sites).collect()))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, M.resolve_hom_refs(calls, coverage, sites=sites).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_one_file_a_bucket_found_by_another_session(spark, tmp_path):
    _, coverage = tables(spark, str(tmp_path))
    files = [f for f in os.listdir(tmp_path / "coverage") if f.startswith("part-")]
    assert len(files) == len({f.split("_")[-1] for f in files}) <= 8
    other = spark.newSession()
    assert sorted(S.read_colocated(other, f"{tmp_path}/coverage").collect()) == sorted(coverage.collect())
    assert sorted(read_matrix(spark, f"{tmp_path}/coverage").select("s", "pos").collect()) == sorted(coverage.select("s", "pos").collect())


def test_written_again(spark, tmp_path):
    """Another number of buckets, other columns and other rows at the same place."""
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, 2), (None, 2, 3), (None, 2, 3)], "s string, pos int, v int")
    assert S.write_colocated(rows, path, buckets=4).count() == 3
    with pytest.raises(Exception, match="non-empty|exists"):
        S.write_colocated(rows, path, buckets=4)
    assert sorted(map(str, S.read_colocated(spark, path).collect())) == sorted(map(str, rows.collect()))
    again = S.write_colocated(rows.limit(1).select("s", "pos", F.array("v").alias("odd name")), path, True, 2)
    assert again.columns == ["s", "pos", "odd name"] and [tuple(r) for r in again.collect()] == [("a", 1, [2])]
    assert S.write_colocated(rows.limit(0), path, True, 2).collect() == []


def test_resolved_cells_become_rows_in_generated_code(spark, tmp_path):
    calls, coverage = tables(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = M.resolve_hom_refs(calls, coverage)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert re.search(r"\*\(\d+\) Generate inline", plan)


def test_resolved_cells_against_plain_rules(spark):
    calls = [("a", 1, "A", "C", 7, None, 50.0, 9.5, ["PASS"]), ("a", 1, "A", "G", 8, 0.5, 50.0, None, None), ("b", 1, "A", None, 9, 0.0, None, 9.5, ["x"]),
             ("b", 2, None, None, 9, 0.1, None, 9.5, ["x"]), ("c", 3, "T", "C", 400, 1.0, 50.0, 9.5, ["PASS"]), (None, 1, "A", "C", 3, None, None, None, [])]
    deep = [("a", 1, 500), ("c", 1, 200), ("d", 1, None), ("d", 2, 900), ("d", 3, 100), ("d", 4, 900), (None, 1, 900)]
    sites = {r[1:4] for r in calls}
    want = []
    for s, pos in {r[:2] for r in calls} | {r[:2] for r in deep}:
        own = {r[2:4]: r[4:] for r in calls if r[:2] == (s, pos)}
        at = [d[2] for d in deep if d[:2] == (s, pos) and s is not None]
        for ref, alt in set(own) | ({t[1:] for t in sites if t[0] == pos} if at else set()):
            if ref is None and alt is None:
                continue
            dp, hl, mq, tlod, ft = own.get((ref, alt), (None,) * 5)
            depth = (at[0] if at else None) if hl is None else dp
            if hl is not None:
                state = (hl, dp, ft)
            elif depth is None:
                state = (None, None, None)
            else:
                state = (0.0, depth, ["PASS"]) if depth > 100 else (None, None, ft)
            want.append((s, pos, ref, alt, mq, tlod, *state))
    # A missing sample meets no coverage, so its coverage is a row of its own.
    want += [(None, 1, ref, alt, None, None, 0.0, 900, ["PASS"]) for _, ref, alt in (t for t in sites if t[0] == 1)]
    got = M.resolve_hom_refs(spark.createDataFrame(calls, CALL), spark.createDataFrame(deep, "s string, pos int, coverage int"))
    got = [(r["s"], r["pos"], r["ref"], r["alt"], r["MQ"], r["TLOD"], r["HL"], r["DP"], r["FT"]) for r in got.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_arrays_that_become_rows_are_made_once(spark, tmp_path):
    """Spark filters by the array of a plain generator first, so that array is made twice."""
    lines = [(i, i % 3, i % 5, i % 7, float(i), 1.0, 0.1, 0.1, "ANR"[i % 3], "OF"[i % 2], None) for i in range(30)]
    spark.createDataFrame(lines, SCHEMAS["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    calls, coverage = tables(spark, str(tmp_path))
    records = spark.createDataFrame([("1", "DP", ["7", "."]), ("2", "DP", []), ("3", "DP", None)], "POS string, FORMAT string, cells array<string>")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "idx int, SampleID string")
    records = records.withColumn("cells", F.reverse("cells"))
    long = [annotate.long_records(records, names, known=known) for known in (False, True)]
    assert [sorted((r["POS"], r["SampleID"], r["SAMPLE_DATA"]) for r in df.collect()) for df in long] == [[("1", "a", "."), ("1", "b", "7")], [("1", "b", "7")]]
    made = [QUERIES[n](spark, str(tmp_path)) for n in ("hgvs_format", "transcript_rank", "transcript_rank_noncoding")]
    for df in [M.resolve_hom_refs(calls, coverage), *long, *made]:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "size(" in line]
        assert df.count() > 0
