"""mtDNA copy number per sample and the QC decision."""

from pyspark.sql import Column, DataFrame, functions as F

from chondria.functions.casts import number
from chondria.operators.summary import mean, median, value_counts


def mt_coverage(coverage: DataFrame) -> DataFrame:
    """``(s, mt_mean, mt_median)``; text that is no number is ignored."""
    return value_counts(coverage, ["s"], number(F.col("coverage"))).groupBy("s").agg(
        mean().alias("mt_mean"), median().alias("mt_median"))


def _ratio(mt: Column, nuclear: Column) -> Column:
    usable = (nuclear > 0) & (nuclear < float("inf"))      # NaN compares above infinity
    return F.when(usable, F.lit(2.0) * mt / nuclear)


def copy_number(mt: DataFrame, nuclear: DataFrame, contamination: DataFrame | None = None, min_coverage: float = 100.0,
                min_copies: float = 50.0, max_copies: float = 500.0, max_contamination: float = 0.02) -> DataFrame:
    """Copy-number table with the QC decision.

    ``mt`` is the output of :func:`mt_coverage`, ``nuclear`` has ``s, nuc_mean, nuc_median`` and
    ``contamination`` ``s, contamination``; without it the estimate is 0.
    """
    rows = mt.join(nuclear, "s")
    rows = rows.withColumn("contamination", F.lit(0.0)) if contamination is None else (
        rows.join(contamination.select("s", "contamination"), "s", "left").fillna(0.0, ["contamination"]))
    final = _ratio(F.col("mt_mean"), F.col("nuc_median"))
    good = ((F.col("mt_mean") >= min_coverage) & (final >= min_copies) & (final <= max_copies)
            & (F.col("contamination") <= max_contamination))
    return rows.select(
        F.col("s").alias("Sample_ID"), F.col("mt_mean").alias("Mean_mtDNA_Coverage"),
        F.col("mt_median").alias("Median_mtDNA_Coverage"), F.col("nuc_mean").alias("Mean_Nuclear_Coverage"),
        F.col("nuc_median").alias("Median_Nuclear_Coverage"),
        _ratio(F.col("mt_mean"), F.col("nuc_mean")).alias("mtCN_mean_mean"),
        _ratio(F.col("mt_median"), F.col("nuc_median")).alias("mtCN_median_median"), final.alias("mtCN_final"),
        F.col("contamination").alias("Contamination"), F.coalesce(good, F.lit(False)).alias("Pass_Filter"))
