"""Coverage and combine jobs over all samples of a manifest."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chondria.operators import matrix
from chondria.plans.stages import fingerprint, output, stage
from chondria.sinks.colocated import BUCKETS, read_colocated, write_colocated
from chondria.sinks.tables import read_matrix, write_matrix, write_tsv, write_wide_coverage
from chondria.sinks.vcf import write_cohort_vcf
from chondria.sources.calls import read_calls
from chondria.sources.coverage import read_coverage
from chondria.sources.reports import read_bed
from chondria.sources.tables import read_manifest


def indexed_samples(manifest: DataFrame) -> DataFrame:
    """``(s, sample_idx)`` in manifest order."""
    return manifest.select("s", F.col("row_no").alias("sample_idx"))


def coverage_job(spark: SparkSession, coverage_path: str, manifest_path: str, out: str, overwrite: bool = False,
                 exact_median: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """Writes the coverage matrix, the per-site table (stored and as text) and the sample-level text table.

    Outputs that are whole and of the same input files are kept; ``overwrite`` writes all of them anew. The matrix lies in ``buckets`` by sample and position.
    """
    key = fingerprint(spark, [coverage_path, manifest_path], exact_median, buckets)
    manifest = read_manifest(spark, manifest_path)
    samples = stage(spark, f"{out}/samples", lambda: indexed_samples(manifest), key, overwrite)
    raw = read_coverage(spark, coverage_path, manifest)
    output(spark, f"{out}/coverage_matrix",
           lambda path: write_colocated(matrix.unique_cells(raw, ["chrom", "pos", "s"]), path, True, buckets), key, overwrite)
    entries = stored_coverage(spark, out)
    n = samples.agg(F.count(F.lit(1))).scalar()
    sites = stage(spark, f"{out}/coverage_sites", lambda: matrix.site_coverage(entries, n, exact_median), key, overwrite)
    output(spark, f"{out}/coverage_sites_tsv", lambda path: write_tsv(sites.orderBy("pos"), path), key, overwrite)
    output(spark, f"{out}/coverage_sample_level", lambda path: write_wide_coverage(entries, samples, path), key, overwrite)
    return sites


def stored_coverage(spark: SparkSession, out: str) -> DataFrame:
    """The coverage matrix that :func:`coverage_job` wrote to ``out``, in its buckets."""
    return read_colocated(spark, f"{out}/coverage_matrix")


def combine_job(spark: SparkSession, calls_path: str, manifest_path: str, coverage: DataFrame, artifact_bed: str,
                out: str, threshold: int = 100, overwrite: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """Writes the raw and the resolved matrix, the site table and the cohort VCF; returns the resolved matrix.

    ``coverage`` is a stored table with ``pos, s, coverage``; that of :func:`stored_coverage`, with as many ``buckets``, meets the calls without an
    exchange. The artifact sites lie on the one contig of the calls. Outputs are kept or written anew as in :func:`coverage_job`.
    """
    key = fingerprint(spark, [calls_path, manifest_path, artifact_bed], sorted(coverage.inputFiles()), threshold, buckets)
    manifest = read_manifest(spark, manifest_path)
    samples = stage(spark, f"{out}/samples", lambda: indexed_samples(manifest), key, overwrite)

    def raw() -> DataFrame:
        entries = matrix.entry_columns(read_calls(spark, calls_path, manifest))
        _, pos = matrix.as_mt(F.col("pos"))
        return matrix.unique_cells(entries.withColumn("pos", pos), ["s", *matrix.SITE])
    output(spark, f"{out}/raw_matrix", lambda path: write_colocated(raw(), path, True, buckets), key, overwrite)
    calls = read_colocated(spark, f"{out}/raw_matrix")
    calls = calls.withColumn("FT", matrix.cleaned_filters(F.col("FT")))
    bed = read_bed(spark, artifact_bed).withColumn("contig", F.lit("MT"))
    found = calls.select(F.lit("MT").alias("contig"), *matrix.SITE).distinct()
    sites = stage(spark, f"{out}/sites", lambda: matrix.flag_artifacts(found, bed), key, overwrite)
    output(spark, f"{out}/matrix",
           lambda path: write_matrix(matrix.resolve_hom_refs(calls, coverage, threshold, sites), path, overwrite=True), key, overwrite)
    cells = read_matrix(spark, f"{out}/matrix")
    whole = cells.withColumn("contig", F.lit("MT"))
    output(spark, f"{out}/combined_vcf", lambda path: write_cohort_vcf(whole, sites, samples, path), key, overwrite)
    return cells
