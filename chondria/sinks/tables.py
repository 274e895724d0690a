"""Stored matrices and tab-separated outputs."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chondria.sinks.wide import block_texts, header_cells, ranged, wide_rows, write_ordered
from chondria.sources.files import require_none


def write_matrix(entries: DataFrame, path: str, overwrite: bool = False, buckets: int = 64) -> DataFrame:
    """Stores long entries in directories by sample bucket, each file sorted by position.

    Rows are spread by bucket and position range, so one large bucket becomes several files.
    """
    rows = entries.withColumn("bucket", F.pmod(F.xxhash64("s"), F.lit(buckets)).cast("int"))
    (rows.repartitionByRange("bucket", "pos", "s").sortWithinPartitions("bucket", "pos", "s")
     .write.mode("overwrite" if overwrite else "errorifexists").partitionBy("bucket").parquet(path))
    return read_matrix(entries.sparkSession, path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def write_tsv(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Tab-separated with a header; missing values and empty texts are both empty."""
    (df.write.mode("overwrite" if overwrite else "errorifexists")
     .csv(path, sep="\t", header=True, nullValue="", emptyValue="", quote='"', escape='"'))


def pivoted_coverage(coverage: DataFrame, samples: list[str], key: str = "pos") -> DataFrame:
    """One row per position, one column per listed sample; for a list short enough to be columns."""
    return coverage.groupBy(key).pivot("s", samples).agg(F.first("coverage", ignorenulls=True))


def _known(coverage: DataFrame, key: str) -> DataFrame:
    return coverage.filter(F.col("coverage").isNotNull()).select(key, "s", F.col("coverage").cast("string").alias("cell"))


def _coverage_line(key: str) -> Column:
    return F.concat_ws("\t", F.col(key).cast("string"), "cells")


def coverage_lines(coverage: DataFrame, samples: DataFrame, key: str = "pos") -> DataFrame:
    """``key, line``: position and the coverage of all samples in order of ``sample_idx``, ``NA`` where missing."""
    wide = wide_rows(_known(coverage, key), coverage.select(key).distinct(), samples, [key], "NA")
    return wide.select(key, _coverage_line(key).alias("line"))


def write_wide_coverage(coverage: DataFrame, samples: DataFrame, path: str, key: str = "pos", files: int | None = None) -> None:
    """Sample-level text table in position order, the header in the first file; works for any number of samples."""
    head = header_cells(samples).select(F.concat(F.lit(key + "\t"), "cells").alias("value"))
    places = ranged(coverage.select(key).distinct(), [key], files)
    texts = block_texts(_known(coverage, key), places.select(key), samples, [key], "NA")
    write_ordered(head, texts, _coverage_line(key), [key], places, path)


def write_report_metadata(reports: DataFrame, directory: str) -> None:
    """Haplogroup and contamination tables from contamination reports."""
    write_tsv(reports.select(F.col("s").alias("Sample_ID"), F.col("major_haplogroup").alias("Full_Haplogroup")),
              f"{directory}/haplogroup_full")
    write_tsv(reports.select(F.col("s").alias("Sample_ID"), F.col("contamination").alias("Contamination_Status")),
              f"{directory}/contamination")


def write_probands(ids: DataFrame, path: str) -> None:
    ids.select("s").distinct().orderBy("s").write.mode("overwrite").text(path)


def write_documents(lines: DataFrame, path: str, doc_id_check: DataFrame | None = None) -> None:
    """Bulk lines as text files; ``doc_id_check`` is a table of violations that must be empty."""
    if doc_id_check is not None:
        require_none(doc_id_check, "document ids")
    lines.write.mode("overwrite").text(path)
