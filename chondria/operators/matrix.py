"""The cohort matrix in long form: one row per known cell, sites and samples as tables.

A cell without a row is a cell whose values are all missing. Work that needs every cell goes through
:func:`densify`; everything else stays proportional to the calls and the coverage rows.
"""

from pyspark.sql import Column, DataFrame, functions as F

from chondria import schema
from chondria.functions.casts import if_known
from chondria.operators.calls import spans_listed
from chondria.operators.joins import lookup_join
from chondria.operators.summary import mean, median, rows_over, value_counts

SITE = ["pos", "ref", "alt"]


def union_samples(*parts: DataFrame) -> DataFrame:
    """Outer union of per-sample tables on the row key."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def unique_cells(entries: DataFrame, keys: list[str]) -> DataFrame:
    """The entries, with an error at run time when a cell occurs twice."""
    values = [c for c in entries.columns if c not in keys]
    n = F.count(F.lit(1))
    row = F.first(F.struct(*values))
    checked = F.when(n > 1, F.raise_error(F.concat_ws(" ", F.lit("cell occurs twice:"), *keys))).otherwise(row)
    return entries.groupBy(*keys).agg(checked.alias("_v")).select(*keys, "_v.*")


def as_mt(pos: Column) -> tuple[Column, Column]:
    """``(contig, pos)`` on the MT contig; positions are the same, and one off the contig is an error."""
    ok = pos.between(1, schema.CONTIG_LENGTH)
    return F.lit("MT"), F.when(ok | pos.isNull(), pos).otherwise(
        F.raise_error(F.concat(F.lit("position off the contig: "), pos.cast("string"))))


def site_coverage(coverage: DataFrame, n_samples: Column, exact: bool = False, key: str = "pos") -> DataFrame:
    """Mean, median and fractions of samples above 100 and 1000 per site.

    ``n_samples`` counts all samples of the manifest, so a missing cell is not over a threshold. The median of
    whole numbers is a whole number unless ``exact``.
    """
    return site_coverage_of_counts(value_counts(coverage, [key], F.col("coverage")), n_samples, exact, key)


def site_coverage_of_counts(counts: DataFrame, n_samples: Column, exact: bool = False, key: str = "pos") -> DataFrame:
    """:func:`site_coverage` from the number ``n`` of samples per site and depth ``v``, as a growing cohort stores it."""
    over = [(rows_over(t).cast("double") / n_samples).alias(f"over_{t}") for t in (100, 1000)]
    return counts.groupBy(key).agg(
        mean().alias("mean"), (median() if exact else F.floor(median()).cast("int")).alias("median"), *over)


def entry_columns(calls: DataFrame) -> DataFrame:
    """``s, pos, ref, alt, DP, HL, MQ, TLOD, FT`` of split single-sample calls."""
    f = F.col("filters")
    return calls.select(
        "s", "pos", F.get("alleles", F.lit(0)).alias("ref"), F.get("alleles", F.lit(1)).alias("alt"), "DP",
        F.get("AF", F.lit(0)).alias("HL"), F.get("MMQ", F.lit(1)).cast("double").alias("MQ"),
        F.get("TLOD", F.lit(0)).alias("TLOD"), pass_if_empty(f).alias("FT"))


def pass_if_empty(filters: Column) -> Column:
    """An empty filter list means PASS; a missing one stays missing."""
    return F.when(filters.isNull(), None).when(F.size(filters) == 0, F.array(F.lit("PASS"))).otherwise(filters)


def cleaned_filters(ft: Column, remove: list[str] | None = None) -> Column:
    names = schema.LOW_VALUE_FILTERS if remove is None else remove
    kept = F.array_except(ft, F.array(*[F.lit(n) for n in names]).cast("array<string>"))
    return pass_if_empty(F.sort_array(kept))


def resolved(hl: Column, dp: Column, ft: Column, coverage: Column, threshold: int) -> list[Column]:
    """``HL, DP, FT`` of a cell with coverage: above the threshold an uncalled cell is reference, else no call."""
    depth = F.when(hl.isNull(), coverage).otherwise(dp)
    hom_ref = hl.isNull() & (depth > threshold)
    no_call = hl.isNull() & (depth <= threshold)
    return [if_known(hom_ref, F.lit(0.0), hl).alias("HL"), if_known(no_call, F.lit(None).cast("int"), depth).alias("DP"),
            if_known(hom_ref, F.array(F.lit("PASS")), ft).alias("FT")]


def resolve_hom_refs(calls: DataFrame, coverage: DataFrame, threshold: int = 100,
                     sites: DataFrame | None = None) -> DataFrame:
    """Cells of the called sites: called, reference or no call, from calls and coverage ``(s, pos, coverage)``.

    Calls and coverage meet once per sample and position, each call list as short as the alleles there; the sites of the position are added
    inside the row. Tables stored in buckets by sample and position (:mod:`chondria.sinks.colocated`) meet without an exchange. The result holds
    each cell with a call or a coverage row once. ``sites``, a stored table, saves finding the sites of the calls, and is broadcast while it is small.
    """
    found = calls.select(*SITE).distinct() if sites is None else sites.select(*SITE)
    values = ["MQ", "TLOD", "HL", "DP", "FT"]
    own = calls.groupBy("s", "pos").agg(F.collect_list(F.struct("ref", "alt", *values)).alias("_calls"))
    at = found.groupBy("pos").agg(F.collect_set(F.struct("ref", "alt", F.lit(None).cast("int").alias("call"))).alias("_sites"))
    met = own.join(coverage.select("s", "pos", "coverage", F.lit(True).alias("_deep")), ["s", "pos"], "full")

    def open_site(site: Column) -> Column:
        return ~F.exists("_calls", lambda c: c["ref"].eqNullSafe(site["ref"]) & c["alt"].eqNullSafe(site["alt"]))
    # A cell is its alleles and the place of its call, if it has one. Where a position has no call of the sample, its sites are taken as they are;
    # the array is made in a step of its own, so that it becomes rows, and these their values, in generated code.
    called = F.transform("_calls", lambda c, i: F.struct(c["ref"], c["alt"], i.alias("call")))
    rest = F.when(F.col("_calls").isNull(), F.col("_sites")).otherwise(F.filter("_sites", open_site))
    rest = F.when(F.col("_deep"), rest)
    cells = F.when(F.col("_calls").isNull(), rest).otherwise(F.concat(called, F.coalesce(rest, F.array())))
    rows = lookup_join(met, at, ["pos"]).select("s", "pos", "coverage", "_calls", cells.alias("_cells"))
    # The outer form, as the plain one has Spark filter by the array first, which computes it again; rows without a cell have neither allele.
    rows = rows.select("s", "pos", "coverage", "_calls", F.inline_outer("_cells")).filter("ref is not null or alt is not null")
    call = F.get("_calls", F.col("call"))
    rows = rows.select("s", *SITE, "coverage", *[call[v].alias(v) for v in values])
    return rows.select("s", *SITE, "MQ", "TLOD", *resolved(F.col("HL"), F.col("DP"), F.col("FT"), F.col("coverage"), threshold))


def cell_state(hl: Column) -> Column:
    return F.when(hl.isNull(), "no_call").when(hl > 0, "called").otherwise("hom_ref")


def state_counts(cells: DataFrame, n_samples: Column) -> DataFrame:
    """Cells per state and site over the whole matrix; cells without a row are counted as no calls."""
    state = cell_state(F.col("HL"))
    called, ref = F.count_if(state == "called"), F.count_if(state == "hom_ref")
    return cells.groupBy(*SITE).agg(called.alias("n_called"), ref.alias("n_hom_ref"),
                                    (n_samples - called - ref).alias("n_no_call"))


def site_states(calls: DataFrame, coverage: DataFrame, n_samples: Column, threshold: int = 100) -> DataFrame:
    """The counts of :func:`state_counts` over the resolved matrix, without building its cells.

    The samples over the threshold are counted per position; at a site those of them with a level of their own are taken
    off again, as they are in the state that the level says. Calls and coverage hold a cell once.
    """
    deep = F.col("coverage") > threshold
    over = coverage.groupBy("pos").agg(F.count_if(deep).alias("_over"))
    known = F.col("HL").isNotNull()
    own = calls.select("s", *SITE, "HL").join(coverage.select("s", "pos", "coverage"), ["s", "pos"], "left").groupBy(*SITE).agg(
        F.count_if(F.col("HL") > 0).alias("n_called"), F.count_if(known & ~(F.col("HL") > 0)).alias("_zero"),
        F.count_if(known & deep).alias("_deep"))
    ref = F.coalesce(F.col("_over"), F.lit(0)) - F.col("_deep") + F.col("_zero")
    return lookup_join(own, over, ["pos"]).select(*SITE, "n_called", ref.alias("n_hom_ref"),
                                                  (n_samples - F.col("n_called") - ref).alias("n_no_call"))


def flag_artifacts(sites: DataFrame, artifact_sites: DataFrame, circular: int | None = None) -> DataFrame:
    """``filters`` of each site: ``artifact_prone_site`` when its reference allele covers a listed base, else PASS.

    ``artifact_sites`` has ``contig, start, end`` of a BED table on the contig of ``sites``; ``circular`` as in :func:`spans_listed`.
    """
    marked = spans_listed(sites, artifact_sites, "_artifact", circular)
    name = F.when(F.col("_artifact"), "artifact_prone_site").otherwise("PASS")
    return marked.withColumn("filters", F.array(name)).drop("_artifact")


def localize(entries: DataFrame, values: list[str], site: list[str] | None = None, order: str = "sample_idx",
             block: int = schema.BLOCK) -> DataFrame:
    """One row per site and block of samples with the entries in sample order.

    ``order`` is the whole-numbered place of the sample; a row holds at most ``block`` entries.
    """
    site = SITE if site is None else site
    entry = F.struct(order, *values)
    return (entries.withColumn("block", F.floor(F.col(order) / block).cast("long"))
            .groupBy(*site, "block").agg(F.sort_array(F.collect_list(entry)).alias("entries")))


def unlocalize(blocks: DataFrame, site: list[str] | None = None) -> DataFrame:
    site = SITE if site is None else site
    return blocks.select(*site, F.inline("entries"))
