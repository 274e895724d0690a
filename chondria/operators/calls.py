"""Call-level jobs: regions, shifted reference, hard filters, masks and allele splitting."""

from pyspark.sql import Column, DataFrame, functions as F

from chondria import schema
from chondria.operators.circular import arcs, wrapped
from chondria.operators.intervals import covered
from chondria.operators.joins import lookup_join, positions

# Call regions of the two references and the rotation between them.
MAIN_REGION = (576, 16024)
SHIFTED_REGION = (8025, 9144)
ROTATION_POINT, ROTATION = 8570, 8000


def in_region(calls: DataFrame, first: int, last: int) -> DataFrame:
    return calls.filter(F.col("pos").between(first, last))


def shifted_back(pos: Column) -> Column:
    """Position on the plain reference of a position on the rotated one."""
    return F.when(pos < ROTATION_POINT, pos + ROTATION).otherwise(pos - (ROTATION_POINT - 1))


def lift_back(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls with plain positions, and rejects that fall outside the contig."""
    moved = calls.withColumn("pos", shifted_back(F.col("pos")))
    valid = F.coalesce(F.col("pos").between(1, schema.CONTIG_LENGTH), F.lit(False))
    return moved.filter(valid), moved.filter(~valid)


def merge_calls(main: DataFrame, lifted: DataFrame) -> DataFrame:
    """Both call sets in position order; ties are ordered by alleles and sample."""
    both = main.unionByName(lifted)
    extra = [c for c in ("ref", "alt", "s") if c in both.columns]
    return both.orderBy("pos", *extra)


def stitch_coverage(plain: DataFrame, shifted: DataFrame) -> DataFrame:
    """Coverage outside the control region plus control-region rows moved back; their row at 8000 is dropped."""
    moved = shifted.withColumn("pos", shifted_back(F.col("pos"))).filter(F.col("pos") != ROTATION)
    return plain.unionByName(moved)


def merge_statistics(*runs: DataFrame) -> DataFrame:
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out.groupBy("statistic").agg(F.sum("value").alias("value"))


def _with_name(filters: Column, name: str, add: Column) -> Column:
    known = F.coalesce(filters, F.array().cast("array<string>"))
    return F.when(F.coalesce(add, F.lit(False)), F.array_union(known, F.array(F.lit(name)))).otherwise(filters)


def hard_filters(calls: DataFrame, min_fraction: float = 0.01, max_alts: int = 4) -> DataFrame:
    """Adds filter names for a low allele fraction and for too many alternate alleles.

    ``AF`` and ``alts`` are arrays, one item per alternate allele; the best fraction counts.
    """
    low = F.array_max("AF") < F.lit(min_fraction)
    many = F.size("alts") > max_alts
    filters = _with_name(F.col("filters"), "low_allele_frac", low)
    return calls.withColumn("filters", _with_name(filters, "multiallelic", many))


def contamination(status: Column, major: Column, minor: Column) -> Column:
    """Estimate reported for a sample: 0 unless the status is YES."""
    level = F.when(major == 0.0, minor).otherwise(F.lit(1.0) - major)
    return F.when(status == "YES", level).otherwise(F.lit(0.0))


def applied_contamination(reported: Column, external: Column) -> Column:
    """Estimate used by the filter: the larger of the reported and an optional external one."""
    return F.greatest(F.coalesce(external, reported), reported)


def spans_listed(records: DataFrame, intervals: DataFrame, name: str, circular: int | None = None) -> DataFrame:
    """Boolean ``name``: whether the reference allele of a record covers a base of the 0-based half-open intervals.

    With ``circular``, the length of a contig without ends, alleles and intervals that go beyond it go on from its first base.

    Works on distinct ``(contig, pos, length of ref)``, each expanded over the bases of its allele and looked up by aligned
    pieces, so that a long interval is never taken apart into bases; the answer is joined back as a lookup.
    """
    spans = (records.select("contig", F.col("pos").cast("long").alias("_at"), F.length("ref").cast("long").alias("_len"))
             .dropna().distinct().withColumn("_to", F.col("_at") + F.col("_len") - 1))
    bases = positions(spans, "_at", "_to", ["contig", "_at", "_len"])
    listed = intervals.select("contig", (F.col("start") + 1).cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    if circular is not None:
        bases, listed = bases.withColumn("pos", wrapped(F.col("pos"), circular)), arcs(listed, circular)
    hit = covered(bases, listed, ["contig"]).select("contig", "_at", "_len").distinct().withColumn(name, F.lit(True))
    marked = (records.withColumn("_at", F.col("pos").cast("long"))
              .withColumn("_len", F.length("ref").cast("long")))
    return (lookup_join(marked, hit, ["contig", "_at", "_len"])
            .withColumn(name, F.coalesce(name, F.lit(False))).drop("_at", "_len"))


def mask_sites(records: DataFrame, mask: DataFrame, filter_name: str = "blacklisted_site", circular: int | None = None) -> DataFrame:
    """Adds ``filter_name`` to the filters of records that overlap a mask interval; ``circular`` as in :func:`spans_listed`."""
    marked = spans_listed(records, mask, "_masked", circular)
    return (marked.withColumn("filters", _with_name(F.col("filters"), filter_name, F.col("_masked")))
            .drop("_masked"))


def split_alleles(calls: DataFrame, per_alt: tuple[str, ...] = (), per_allele: tuple[str, ...] = ()) -> DataFrame:
    """One row per alternate allele, alleles as written.

    ``per_alt`` arrays keep the item of the allele; ``per_allele`` arrays keep the reference item and that one.
    Other columns, among them allele counts, stay as they are.
    """
    kept = [c for c in calls.columns if c not in ("alts", *per_alt, *per_allele)]
    rows = calls.select(*kept, *per_alt, *per_allele, F.posexplode("alts").alias("alt_idx", "alt"))
    i = F.col("alt_idx")
    return rows.select(*kept, "alt", "alt_idx", *[F.get(F.col(c), i).alias(c) for c in per_alt],
                       *[F.array(F.get(F.col(c), F.lit(0)), F.get(F.col(c), i + 1)).alias(c) for c in per_allele])


def unfiltered(calls: DataFrame) -> DataFrame:
    return calls.filter(F.size("filters") == 0)
