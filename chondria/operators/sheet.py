"""Sample-sheet work: validation, grouping into files per sample, branching and gating."""

import re

from pyspark.sql import Column, DataFrame, functions as F

from chondria import schema
from chondria.operators.joins import keep_listed, number_within
from chondria.sources.files import path_key


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def valid_rows(sheet: DataFrame) -> DataFrame:
    return sheet.filter(~_blank(F.col("id")) & (F.col("file1") != ""))


def file_type(path: Column) -> Column:
    return (F.when(path.endswith(".fastq.gz") | path.endswith(".fq.gz"), "FASTQ")
            .when(path.endswith(".cram"), "CRAM").when(path.endswith(".bam"), "BAM").otherwise("UNKNOWN"))


def with_file_type(sheet: DataFrame) -> DataFrame:
    return sheet.withColumn("type", file_type(F.col("file1")))


def sample_groups(typed: DataFrame) -> DataFrame:
    """One row per sample: ``type, n_files, problem``; ``problem`` is NULL for a usable sample.

    Only counts and extremes are kept per sample, never the list of its files.
    """
    facts = typed.groupBy("id").agg(
        F.min("type").alias("type"), F.max("type").alias("_other"), F.count(F.lit(1)).alias("n_files"),
        F.count_if(_blank(F.col("file2"))).alias("_no_index"))
    single = F.col("type").isin("CRAM", "BAM")
    problem = (F.when(F.col("type") != F.col("_other"), "mixed file types")
               .when(F.col("type") == "UNKNOWN", "unknown file type")
               .when(single & (F.col("n_files") > 1), "more than one file")
               .when((F.col("type") == "CRAM") & (F.col("_no_index") > 0), "missing index"))
    return facts.select("id", "type", "n_files", problem.alias("problem"))


def usable_rows(typed: DataFrame) -> DataFrame:
    """Rows of the samples without a problem."""
    good = sample_groups(typed).filter(F.col("problem").isNull())
    return keep_listed(typed, good, "id")


def split_by_type(typed: DataFrame) -> dict[str, DataFrame]:
    return {t: typed.filter(F.col("type") == t) for t in ("FASTQ", "CRAM", "BAM")}


def file_pairs(typed: DataFrame, order: str = "row_no") -> DataFrame:
    """``id, pair_id, file1, file2`` with a 0-based pair number in sheet order.

    ``order`` is a unique whole number per row.
    """
    return number_within(typed, ["id"], order, "pair_id").select("id", "pair_id", "file1", "file2")


def branch(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples with several files to merge, and samples with one."""
    merge = F.col("n_files") > 1
    return groups.filter(merge), groups.filter(~merge)


def mix(*channels: DataFrame) -> DataFrame:
    """All rows of all channels; duplicates stay."""
    out = channels[0]
    for c in channels[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def join_channels(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Inner join on the sample id; unmatched samples are dropped."""
    return left.join(right, key)


def complete_rows(df: DataFrame, needed: list[str]) -> DataFrame:
    return df.dropna(subset=needed).select(*needed)


def pass_column(names: list[str]) -> str | None:
    """Name of the QC column: ``pass`` or ``pass filter`` with a blank, underscore or nothing between."""
    return next((n for n in names if re.fullmatch(r"(?i)pass([_\s]?filter)?", n.strip())), None)


def passed(value: Column) -> Column:
    """Whether a QC cell says pass; anything unknown or missing fails."""
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin(schema.PASS_WORDS), F.lit(False))


def gate(rows: DataFrame, qc: DataFrame, key: str = "s") -> tuple[DataFrame, DataFrame]:
    """Rows of passing samples, and the QC rows of failing ones. A single column beside the key is the verdict, whatever its name."""
    others = [c for c in qc.columns if c != key]
    name = pass_column(qc.columns) or (others[0] if len(others) == 1 else None)
    ok = passed(F.col(f"`{name}`")) if name else F.lit(False)
    return keep_listed(rows, qc.filter(ok).select(key), key), qc.filter(~ok)


def sample_ids(sheet: DataFrame) -> DataFrame:
    """Distinct non-blank ids in order; a header row is recognised by all its cells, not by its id alone."""
    header = F.lower("id").isin(schema.SAMPLE_COLUMNS) & F.lower("file1").startswith("file")
    return (sheet.filter(~_blank(F.col("id")) & ~F.coalesce(header, F.lit(False)))
            .select("id").distinct().orderBy("id"))


def rows_of_sample(sheet: DataFrame, sample: str) -> DataFrame:
    return sheet.filter(F.col("id") == sample)


def manifest_subset(participants: DataFrame, wanted: DataFrame, path_column: str, existing: DataFrame | None = None,
                    order: str = "row_no") -> DataFrame:
    """``(s, path)`` of the wanted participants with an existing call file; a sample's last row wins.

    ``participants`` has ``participant, s, <path_column>, <order>``; ``existing`` lists ``path_key``.
    """
    rows = participants.filter(F.col(path_column) != "").withColumnRenamed(path_column, "path")
    rows = keep_listed(rows, wanted, "participant")
    if existing is not None:
        rows = keep_listed(rows.withColumn("path_key", path_key(F.col("path"))), existing, "path_key")
    return rows.groupBy("s").agg(F.max_by("path", order).alias("path"))
