"""Variant lists: of single samples, and of a cohort with its counts."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from chondria import schema
from chondria.operators import annotate as A
from chondria.plans.stages import fingerprint, output, stage
from chondria.sinks.tables import write_tsv
from chondria.sources import tables

# Source columns each resource reader needs, and whether ``#`` starts a comment in its file.
RESOURCE_FILES = {
    "gnomad": (A.gnomad, ["ref", "position", "alt", "max_observed_heteroplasmy", "AF_hom", "AF_het"], True),
    "mitomap_poly": (A.mitomap_polymorphisms, ["ref", "pos", "alt", "gbcnt"], True),
    "mitomap_dis": (A.mitomap_disease, ["ref", "pos", "alt", "status", "homoplasmy", "heteroplasmy", "disease"], True),
    "apogee": (A.apogee, ["Ref", "Start", "Alt", "APOGEE1", "APOGEE2"], True),
    "hmtvar": (A.hmtvar, ["REF", "POS", "ALT", "HmtVar"], True),
    "mitotip": (A.mitotip, ["rCRS", "Position", "Alt", "Quartile"], False),
    "helix": (A.helix, ["locus", "alleles", "AF_hom", "AF_het", "max_ARF"], False),
    "clinvar": (A.clinvar, ["GRCh38Location", "Canonical SPDI", "Germline classification"], False),
    "haplo": (A.haplogroup_variants, ["Variant", "Assoc_haplogroups"], False),
}


def read_resources(spark: SparkSession, paths: dict[str, str]) -> list[DataFrame]:
    """Resource tables of the files in ``paths``, named as in ``RESOURCE_FILES``."""
    parts = []
    for name, path in paths.items():
        normalise, columns, commented = RESOURCE_FILES[name]
        read = tables.read_commented if commented else tables.read_strings
        parts.append(normalise(read(spark, path, columns)))
    return parts


def single_prefilter(rows: DataFrame, resources: list[DataFrame] | DataFrame, haplogroups: DataFrame,
                     status: DataFrame | None = None, metadata: DataFrame | None = None, positional: bool = False) -> DataFrame:
    """Long records, every sample annotated on its own.

    ``rows`` has the fixed columns, ``SampleID`` and ``SAMPLE_DATA``; ``haplogroups`` is ``(s, haplogroup)`` and
    ``status`` ``(s, contamination)``. Contaminated samples give no rows.
    """
    kept = A.without_hard_filters(rows)
    if status is not None:
        kept = A.uncontaminated(kept, status, "SampleID")
    parsed = (A.format_by_position if positional else A.format_by_tag)(kept)
    parsed = A.consequence_fields(parsed, schema.CONSEQUENCE_COLUMNS)
    parsed = A.with_haplogroup(parsed, haplogroups, "SampleID")
    if metadata is not None:
        parsed = A.with_category(parsed, metadata, "SampleID")
    if "Freq" not in parsed.columns:
        parsed = parsed.withColumn("Freq", F.lit(0))
    return A.completed(A.annotated(parsed, resources).withColumnRenamed("SampleID", "SAMPLE_ID"), schema.SINGLE_LIST)


def cohort_prefilter(rows: DataFrame, resources: list[DataFrame] | DataFrame, probands: DataFrame | None = None,
                     carriers_only: bool = False, count_all_rows: bool = False, prefix: bool = False) -> DataFrame:
    """Long cohort records with in-cohort counts, annotated; ``probands`` restricts the samples."""
    if probands is not None:
        rows = A.of_probands(rows, probands, "SampleID", prefix)
    parsed = A.format_by_tag(A.without_hard_filters(rows))
    if carriers_only:
        parsed = A.carriers(parsed)
    # The fields in use are shorter than the texts they come from, which are not shuffled then.
    parsed = A.cohort_counts(A.consequence_fields(parsed, schema.CONSEQUENCE_COLUMNS), count_all_rows, resources)
    return A.completed(A.annotated(parsed, None), schema.COHORT_LIST)


def final_list(prefilter: DataFrame, max_freq: int = 100, disease_first: bool = False) -> DataFrame:
    """The candidates of a prefilter list in order. Sorting reads its input twice, so a job gives it the written prefilter."""
    return A.keep_candidates(prefilter, max_freq).orderBy(*A.list_order(prefilter, disease_first))


def lists_job(prefilter: DataFrame, out: str, proband_mode: bool = False, max_freq: int = 100, disease_first: bool = False,
              overwrite: bool = False, inputs: list[str] | None = None) -> DataFrame:
    """Writes the list pair and returns the final one. The prefilter list is stored first: both texts come from the stored
    rows, so that the annotation runs once. ``inputs`` are the paths whose change makes stored results stale."""
    spark = prefilter.sparkSession
    key = fingerprint(spark, inputs or prefilter.inputFiles(), proband_mode, max_freq, disease_first)
    lead = "Proband_" if proband_mode else ""
    stored = stage(spark, f"{out}/{lead}prefilter", lambda: prefilter, key, overwrite)
    final = final_list(stored, max_freq, disease_first)
    output(spark, f"{out}/{lead}variant_list_prefiltering", lambda path: write_tsv(stored, path), key, overwrite)
    output(spark, f"{out}/{lead}variant_list", lambda path: write_tsv(final, path), key, overwrite)
    return final
