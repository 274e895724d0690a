"""A stored document table that a merge rewrites only where it meets it.

Documents lie in buckets by a hash of their id. A merge reads and writes the buckets of its incoming ids alone, as a new version beside the old ones;
which version of a bucket is live follows from the versions whose end is marked. A merge that fails or is cut off leaves the table as it was.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chondria.operators.documents import apply_documents
from chondria.plans.growth import whole_numbers
from chondria.plans.stages import _mark

BUCKETS = 256
#: Tasks and files that a bucket is dealt to, where it is large.
SPLIT = 8


def bucket_of(doc_id: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


def newest(incoming: DataFrame, doc_id: str, order: str | None) -> DataFrame:
    """One row per id: the one with the greatest ``order``. Without ``order`` a repeated id is an error at run time."""
    rest = F.struct(*[c for c in incoming.columns if c != doc_id])
    if order is not None:
        row = F.max_by(rest, order)
    else:
        message = F.concat(F.lit("document comes twice: "), F.col(doc_id).cast("string"))
        row = F.when(F.count(F.lit(1)) > 1, F.raise_error(message)).otherwise(F.first(rest))
    return incoming.groupBy(doc_id).agg(row.alias("_row")).select(doc_id, "_row.*")


def _live(spark: SparkSession, root: str) -> dict[int, list[int]]:
    """The buckets that are live in each version; a row a bucket on the driver."""
    found = None
    for n in whole_numbers(spark, root, "v"):
        part = spark.read.parquet(f"{root}/v={n}/buckets").withColumn("v", F.lit(n))
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError(f"{root} holds no document table")
    out: dict[int, list[int]] = {}
    for r in found.groupBy("bucket").agg(F.max("v").alias("v")).collect():
        out.setdefault(r["v"], []).append(r["bucket"])
    return out


def read_store(spark: SparkSession, root: str, only: list[int] | None = None) -> DataFrame:
    """All documents, or those of some buckets. A field that a bucket's version lacks is missing there."""
    found = None
    for n, buckets in sorted(_live(spark, root).items()):
        wanted = buckets if only is None else sorted(set(buckets) & set(only))
        part = spark.read.parquet(f"{root}/v={n}/data").filter(F.col("bucket").isin(wanted)).drop("bucket")
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return found


def _write(rows: DataFrame, buckets: DataFrame, root: str, number: int, doc_id: str, n_buckets: int) -> None:
    spark, at = rows.sparkSession, f"{root}/v={number}"
    (rows.withColumn("bucket", bucket_of(doc_id, n_buckets)).repartition("bucket", F.pmod(F.hash(doc_id), F.lit(SPLIT))).sortWithinPartitions("bucket", doc_id)
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{at}/data"))
    buckets.write.mode("overwrite").parquet(f"{at}/buckets")
    _mark(spark, f"{at}.done", "whole")


def write_store(docs: DataFrame, root: str, doc_id: str, buckets: int = BUCKETS) -> None:
    """Starts a document table; every bucket of it is live, empty ones too."""
    if whole_numbers(docs.sparkSession, root, "v"):
        raise FileExistsError(f"{root} holds a document table")
    _write(docs, docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")), root, 1, doc_id, buckets)


def merge_store(spark: SparkSession, root: str, incoming: DataFrame, doc_id: str, operation: str = "index", order: str | None = None,
                ignore_errors: bool = False) -> int:
    """Applies a write operation (:func:`chondria.operators.documents.apply_documents`) to the table; returns how many buckets it rewrote.

    Of incoming rows with one id the newest by ``order`` counts. Files of other buckets are neither read nor written.
    """
    live = _live(spark, root)
    n_buckets = sum(map(len, live.values()))
    met = incoming.select(bucket_of(doc_id, n_buckets).alias("bucket")).distinct()
    touched = sorted(r["bucket"] for r in met.collect())
    if not touched:
        return 0
    after = apply_documents(read_store(spark, root, touched), newest(incoming, doc_id, order), doc_id, operation, ignore_errors)
    buckets = spark.createDataFrame([(b,) for b in touched], "bucket int")
    _write(after, buckets, root, whole_numbers(spark, root, "v")[-1] + 1, doc_id, n_buckets)
    return len(touched)
