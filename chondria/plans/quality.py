"""Copy number of all samples and the gate that drops failing ones."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chondria.operators import calls, copynumber
from chondria.sinks.tables import write_report_metadata, write_tsv
from chondria.sources.reports import read_contamination, read_coverage_metrics


def reported_contamination(reports: DataFrame) -> DataFrame:
    """``(s, contamination)`` estimates of contamination reports."""
    level = calls.contamination(F.col("contamination"), F.col("major_level"), F.col("minor_level"))
    return reports.select("s", level.alias("contamination"))


def quality_job(spark: SparkSession, coverage: DataFrame, metrics_path: str, report_path: str | None, out: str,
                **limits: float) -> DataFrame:
    """Writes the copy-number table of all samples, and the report metadata when there are reports."""
    reports = read_contamination(spark, report_path) if report_path else None
    if reports is not None:
        write_report_metadata(reports, out)
    table = copynumber.copy_number(copynumber.mt_coverage(coverage), read_coverage_metrics(spark, metrics_path),
                                   None if reports is None else reported_contamination(reports), **limits)
    write_tsv(table, f"{out}/mtCN_summary")
    return table
