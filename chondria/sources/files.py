"""File discovery and the helpers shared by the readers."""

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from chondria.operators.joins import lookup_join

CALL_FILES = r"merged\.final\.split\.vcf(\.gz)?$"
COVERAGE_FILES = r"merged\.per_base_coverage\.tsv(\.gz)?$"


def path_key(path: Column) -> Column:
    """Path without its scheme, so that listed and scanned paths compare equal."""
    return F.regexp_replace(path, "^[A-Za-z0-9]+:/+", "/")


def file_order() -> list[Column]:
    """Sort key that follows the line order: file, split start, row within the split."""
    return [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """``(row_no, value)`` of the non-blank lines, numbered from 0 without gaps in file and line order.

    Lines are numbered inside their file split; only one row per split takes part in the running total.
    """
    rows = spark.read.text(path).filter(F.trim("value") != "").select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"))
    splits = rows.groupBy("_file", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    return (lookup_join(rows, bases, ["_file", "_start"], "inner")
            .select((F.col("_base") + F.col("_id") - F.col("_first")).alias("row_no"), "value"))


def sample_of_file(file_name: Column) -> Column:
    """Sample id from a result file name; the same rule for call and coverage files."""
    return F.regexp_replace(file_name, r"(\.merged)?\.(final\.split\.vcf|per_base_coverage\.tsv)(\.gz)?$", "")


def sample_before_dot(file_name: Column) -> Column:
    return F.substring_index(file_name, ".", 1)


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``(path, file, s)`` of the files below ``root`` whose name matches; contents are not read."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
              .select("path", F.element_at(F.split("path", "/"), -1).alias("file")))
    return listed.filter(F.col("file").rlike(pattern)).withColumn("s", sample_of_file(F.col("file")))


def known_files(spark: SparkSession, root: str) -> DataFrame:
    """One ``path_key`` per existing file below ``root``."""
    with many_files(spark):
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
                .select(path_key(F.col("path")).alias("path_key")))


@contextmanager
def many_files(spark: SparkSession):
    """For listing and reading thousands of small files: a task for many folders or files, where Spark has one for each folder and for a few files.

    There are still some tasks a core. Settings come back as they were; a scan counts by those of the time when it runs.
    """
    ours = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism), "spark.sql.files.openCostInBytes": "256k"}
    before = {k: spark.conf.get(k, None) for k in ours}
    try:
        for k, v in ours.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_or_empty(read, spark: SparkSession, schema: str) -> DataFrame:
    """Result of ``read()``, or an empty DataFrame when the path or glob matches nothing."""
    try:
        return read()
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def require_columns(df: DataFrame, names: list[str], what: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return df


def require_none(df: DataFrame, what: str) -> None:
    """Raise when ``df``, a table of violations, has a row. Reads one row only."""
    found = df.take(1)
    if found:
        raise ValueError(f"{what}: {found[0].asDict()}")
