"""Registered queries: each reads whole driver tables through a derived input and runs one operator or job."""

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chondria import schema
from chondria.functions import consequence as C, lof, names, variant as V
from chondria.operators import annotate as A, blocks as B, calls as L, circular, copynumber as N, documents as D, matrix as M, reads as R, templates
from chondria.operators.storage import scratch_path, settled
from chondria.operators import sheet as S
from chondria.plans.lists import cohort_prefilter, final_list, single_prefilter
from chondria.plans.quality import reported_contamination
from chondria.registry.inputs import TRANSCRIPT_FIELDS, derived, load
from chondria.sinks.colocated import write_colocated
from chondria.sinks.tables import coverage_lines, pivoted_coverage
from chondria.sinks.vcf import body_lines, proband_lines

FAMILIES = [f"F{i}" for i in range(25)]       # the columns of the pivot, whose feature is a given list
MAX_FREQ = 600
TARGETS = [("chrM", 576, 16024), ("chr1", 1, 2000)]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _names(text: Column) -> Column:
    return F.array_join(text, ";")


def _n_samples(spark, sf) -> Column:
    return load(spark, sf, "supplier").agg(F.count(F.lit(1))).scalar()


# --- coverage and matrix ------------------------------------------------------------------------------

@query
def coverage_site_summary(spark, sf):
    return M.site_coverage(derived(spark, sf, "coverage"), _n_samples(spark, sf))


@query
def coverage_wide_pivot(spark, sf):
    return pivoted_coverage(derived(spark, sf, "family_coverage"), FAMILIES)


@query
def coverage_wide_lines(spark, sf):
    return coverage_lines(derived(spark, sf, "family_coverage"), derived(spark, sf, "families"))


@query
def cohort_union(spark, sf):
    lines = derived(spark, sf, "coverage")
    low, high = lines.filter("pos <= 8000"), lines.filter("pos > 8000").withColumn("late", F.lit(True))
    return M.unique_cells(M.union_samples(low, high), ["s", "pos"])


def _entries(spark, sf, name="calls"):
    """Calls as read from split single-sample files, reduced to matrix entries."""
    filters = (F.when(F.col("DP") % 17 == 0, None).when(F.col("flag") == "A", F.array(F.lit("possible_numt")))
               .when(F.col("flag") == "R", F.array(F.lit("strand_bias"), F.lit("FAIL")))
               .otherwise(F.array().cast("array<string>")))
    calls = derived(spark, sf, name).select(
        "s", "pos", F.array("ref", "alt").alias("alleles"), filters.alias("filters"), "DP",
        F.array("HL").alias("AF"), F.array(F.lit(0.0), F.col("MQ")).alias("MMQ"), F.array("TLOD").alias("TLOD"))
    return M.entry_columns(calls)


def _clean(entries):
    return entries.withColumn("FT", M.cleaned_filters(F.col("FT")))


@query
def entry_projection(spark, sf):
    return _entries(spark, sf).withColumn("FT", _names("FT"))


@query
def ft_clean(spark, sf):
    return _clean(_entries(spark, sf)).select("s", "pos", "ref", "alt", _names("FT").alias("FT"))


def _resolved(spark, sf):
    return M.resolve_hom_refs(_clean(_entries(spark, sf)), derived(spark, sf, "coverage"))


@query
def homref_resolve(spark, sf):
    return _resolved(spark, sf).withColumn("FT", _names("FT")).withColumn("state", M.cell_state(F.col("HL")))


@query
def homref_colocated(spark, sf):
    """The resolved matrix from calls and coverage that lie in the same buckets by sample and position."""
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))      # a bucket is a task, so they follow the cluster
    calls = write_colocated(_clean(_entries(spark, sf)), scratch_path(spark, "calls"), buckets=buckets)
    coverage = write_colocated(derived(spark, sf, "coverage"), scratch_path(spark, "coverage"), buckets=buckets)
    sites = settled(calls.select(*M.SITE).distinct(), "sites")
    return M.resolve_hom_refs(calls, coverage, sites=sites).withColumn("FT", _names("FT")).withColumn("state", M.cell_state(F.col("HL")))


@query
def homref_state_counts(spark, sf):
    return M.state_counts(_resolved(spark, sf), _n_samples(spark, sf))


def _sites(spark, sf):
    return derived(spark, sf, "calls").select("pos", "ref", "alt").distinct().withColumn("contig", F.lit("MT"))


@query
def artifact_flag(spark, sf):
    return M.flag_artifacts(_sites(spark, sf), derived(spark, sf, "bed")).withColumn("filters", _names("filters"))


@query
def circular_artifact_flag(spark, sf):
    return M.flag_artifacts(_sites(spark, sf), derived(spark, sf, "bed"), schema.CONTIG_LENGTH).withColumn("filters", _names("filters"))


@query
def locus_mt(spark, sf):
    contig, pos = M.as_mt(F.col("pos"))
    return derived(spark, sf, "coverage").select("s", contig.alias("contig"), pos.alias("pos"), "coverage")


def _indexed(spark, sf):
    return derived(spark, sf, "calls").select("pos", "ref", "alt", "DP", "HL",
                                              F.substring("s", 2, 20).cast("long").alias("sample_idx"))


@query
def matrix_blocks(spark, sf):
    blocks = M.localize(_indexed(spark, sf), ["DP"])
    cells = F.transform("entries", lambda e: F.concat_ws(":", e["sample_idx"], e["DP"]))
    return blocks.select("pos", "ref", "alt", "block", F.array_join(cells, ",").alias("cells"))


@query
def matrix_localize_roundtrip(spark, sf):
    return M.unlocalize(M.localize(_indexed(spark, sf), ["DP", "HL"]))


@query
def matrix_densify(spark, sf):
    calls = derived(spark, sf, "family_calls").select("s", "pos", "ref", "alt", "DP", "HL")
    return B.densify(calls, calls, derived(spark, sf, "families"))


def family_matrix(spark, sf):
    """Cells, sites with their filters, and samples of the cohort by families."""
    cells = _clean(_entries(spark, sf, "family_calls")).withColumn("contig", F.lit("MT"))
    sites = cells.select("contig", "pos", "ref", "alt").distinct()
    return cells, M.flag_artifacts(sites, derived(spark, sf, "bed")), derived(spark, sf, "families")


def _family_lines(spark, sf):
    return body_lines(*family_matrix(spark, sf))


@query
def vcf_lines(spark, sf):
    return _family_lines(spark, sf)


def _vcf_records(spark, sf):
    """The cohort VCF lines read back as records whose cells stay one text."""
    names = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "cells"]
    pieces = F.array(F.split("line", "\t", len(names)))
    # A row of its own, as a filter by one of the columns would go below them and make the line again.
    return _family_lines(spark, sf).select(F.inline_outer(F.transform(pieces, lambda p: F.struct(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(names)]))))


def _vcf_samples(spark, sf):
    return derived(spark, sf, "families").select(F.col("sample_idx").cast("int").alias("idx"),
                                                 F.col("s").alias("SampleID"))


@query
def variant_long(spark, sf):
    cells = _clean(_entries(spark, sf, "family_calls")).withColumn("contig", F.lit("MT"))
    sites = M.flag_artifacts(cells.select("contig", "pos", "ref", "alt").distinct(), derived(spark, sf, "bed"))
    places = B.sample_places(derived(spark, sf, "families").select("s", "sample_idx"))
    return B.long_records(B.array_blocks(cells, sites, places, ["DP", "HL"], beside=["filters"]))


@query
def variant_long_carriers(spark, sf):
    rows = A.long_records(_vcf_records(spark, sf), _vcf_samples(spark, sf), known=True)     # a cell without a level has no carrier
    return A.carriers(A.format_by_tag(rows)).select("SampleID", "POS", "REF", "ALT", "Heteroplasmy")


@query
def homref_blocks(spark, sf):
    """The resolved matrix by array blocks; only cells that are known go out."""
    calls, coverage = _clean(_entries(spark, sf, "calls")), derived(spark, sf, "coverage")
    places = B.sample_places(derived(spark, sf, "samples").select("s"))
    rows = B.cells_of(B.resolved_blocks(calls, coverage, places))
    return rows.filter("HL is not null or DP is not null").select("s", "pos", "ref", "alt", "HL", "DP", F.array_join("FT", ";").alias("FT"))


def _family_probands(spark, sf):
    meta = derived(spark, sf, "samples").select(F.col("family").alias("s"), "category")
    return A.probands(meta)


@query
def proband_vcf(spark, sf):
    lines, _ = proband_lines(_vcf_records(spark, sf), _vcf_samples(spark, sf), _family_probands(spark, sf))
    return lines.select("pos", "ref", "alt", "line")


# --- quality control ------------------------------------------------------------------------------------

def _nuclear(spark, sf):
    depth = F.floor("s_acctbal").cast("double") / F.lit(800.0)
    return load(spark, sf, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("s"), depth.alias("nuc_mean"),
        F.when(F.col("s_suppkey") % 9 == 0, 0.0).otherwise(depth + 1.0).alias("nuc_median"))


def _reports(spark, sf):
    return load(spark, sf, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("s"),
        F.when(F.col("s_nationkey") % 5 == 0, "YES").otherwise("NO").alias("contamination"),
        F.when(F.col("s_nationkey") == 5, 0.0).otherwise(F.lit(1.0) - F.col("s_nationkey").cast("double") / 100.0)
        .alias("major_level"), F.lit(0.015).alias("minor_level"))


def _mtcn(spark, sf):
    return N.copy_number(N.mt_coverage(derived(spark, sf, "coverage").withColumn("coverage", F.col("coverage").cast("string"))),
                         _nuclear(spark, sf), reported_contamination(_reports(spark, sf)))


@query
def sample_qc_mtcn(spark, sf):
    return _mtcn(spark, sf)


@query
def contamination_estimate(spark, sf):
    external = load(spark, sf, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("s"),
        F.when(F.col("s_suppkey") % 4 == 0, None).otherwise((F.col("s_suppkey") % 4).cast("double") / 100.0).alias("ext"))
    both = reported_contamination(_reports(spark, sf)).join(external, "s")
    return both.select("s", F.col("contamination").alias("reported"),
                       L.applied_contamination(F.col("contamination"), F.col("ext")).alias("applied"))


@query
def qc_gate(spark, sf):
    qc = _mtcn(spark, sf).select(F.col("Sample_ID").alias("s"), F.col("Pass_Filter").cast("string").alias("pass filter"))
    kept, _ = S.gate(derived(spark, sf, "calls"), qc)
    return kept.select("s", "pos", "ref", "alt", "DP")


@query
def qc_failed(spark, sf):
    qc = _mtcn(spark, sf).select(F.col("Sample_ID").alias("s"), "mtCN_final", "Pass_Filter")
    return S.gate(derived(spark, sf, "calls"), qc)[1]


# --- sample sheet -----------------------------------------------------------------------------------------

def _typed(spark, sf):
    return S.with_file_type(S.valid_rows(derived(spark, sf, "sheet")))


@query
def sheet_file_types(spark, sf):
    return _typed(spark, sf)


@query
def sheet_group_validate(spark, sf):
    return S.sample_groups(_typed(spark, sf))


@query
def sheet_usable(spark, sf):
    return S.usable_rows(_typed(spark, sf)).select("row_no", "id", "type")


@query
def sheet_pairs(spark, sf):
    return S.file_pairs(S.split_by_type(_typed(spark, sf))["FASTQ"])


@query
def sheet_branch_union(spark, sf):
    merge, single = S.branch(S.sample_groups(_typed(spark, sf)).filter("problem is null"))
    return S.mix(merge.withColumn("route", F.lit("merge")), single.withColumn("route", F.lit("single"))).drop("problem")


@query
def sheet_join(spark, sf):
    done = load(spark, sf, "customer").select(F.concat(F.lit("P"), "c_custkey").alias("id"),
                                              F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("cost"))
    joined = S.join_channels(S.sample_groups(_typed(spark, sf)), done.withColumn(
        "cost", F.when(F.col("cost") > 0, F.col("cost"))))
    return S.complete_rows(joined, ["id", "type", "n_files", "segment", "cost"])


@query
def sheet_sample_ids(spark, sf):
    return S.sample_ids(derived(spark, sf, "sheet"))


@query
def sheet_one_sample(spark, sf):
    return S.rows_of_sample(derived(spark, sf, "sheet"), "P7")


@query
def manifest_subset(spark, sf):
    orders = load(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    table = orders.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("participant"), F.col("o_orderkey").alias("row_no"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 700).cast("string")).alias("s"),
        F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit("gs://calls/"), key)).alias("vcf"))
    wanted = load(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("participant"))
    existing = orders.filter("o_orderstatus <> 'P'").select(F.concat(F.lit("/calls/"), key).alias("path_key"))
    return S.manifest_subset(table, wanted, "vcf", existing)


# --- calls ---------------------------------------------------------------------------------------------------

@query
def region_calls(spark, sf):
    calls = derived(spark, sf, "calls").select("s", "pos", "ref", "alt")
    return L.in_region(calls, *L.MAIN_REGION)


@query
def lift_back_merge(spark, sf):
    calls = derived(spark, sf, "calls").select("s", "pos", "ref", "alt")
    lifted, _ = L.lift_back(L.in_region(calls, *L.SHIFTED_REGION))
    return L.merge_calls(L.in_region(calls, *L.MAIN_REGION).withColumn("origin", F.lit("main")),
                         lifted.withColumn("origin", F.lit("shifted")))


@query
def lift_back_rejects(spark, sf):
    moved = derived(spark, sf, "calls").select("s", (F.col("pos") * 2).alias("pos"), "ref", "alt")
    return L.lift_back(moved)[1]


@query
def shift_back_stitch(spark, sf):
    cov = derived(spark, sf, "coverage")
    return L.stitch_coverage(cov.filter(F.col("pos").between(*L.MAIN_REGION)), cov)


@query
def merge_stats(spark, sf):
    runs = [load(spark, sf, "lineitem").filter(F.col("l_linestatus") == status).select(
        F.col("l_returnflag").alias("statistic"), F.col("l_quantity").cast("bigint").alias("value")) for status in "FO"]
    return L.merge_statistics(*runs)


def _multi(spark, sf):
    alts = F.slice(F.array(*[F.lit(a) for a in ("A", "CC", "G", "TT", "GA")]), 1, F.col("l_linenumber") % 5 + 1)
    return derived(spark, sf, "multi").select(
        "s", "pos", "ref", "l_orderkey", "l_linenumber", "q", "flag", alts.alias("alts")).withColumns({
            "AF": F.transform("alts", lambda a, i: F.col("q").cast("double") / (F.lit(1000.0) * (i + 1))),
            "AD": F.transform(F.concat(F.array("ref"), "alts"), lambda a, i: F.col("q") + i),
            "filters": F.when(F.col("flag") == "A", F.array(F.lit("weak_evidence"))).otherwise(
                F.array().cast("array<string>"))})


def _shown(df, **arrays):
    return df.select("s", "pos", "ref", "l_orderkey", "l_linenumber", "q", *[c.alias(n) for n, c in arrays.items()])


@query
def hard_filters(spark, sf):
    return _shown(L.hard_filters(_multi(spark, sf)), filters=_names("filters"), n_alts=F.size("alts"))


@query
def split_multiallelic(spark, sf):
    rows = L.split_alleles(_multi(spark, sf), ("AF",), ("AD",))
    return _shown(rows, alt=F.col("alt"), alt_idx=F.col("alt_idx"), AF=F.col("AF"),
                  AD=F.array_join(F.transform("AD", lambda x: x.cast("string")), ","))


@query
def pass_only(spark, sf):
    return _shown(L.unfiltered(L.hard_filters(_multi(spark, sf))), n_alts=F.size("alts"))


@query
def mask_overlap(spark, sf):
    rows = _entries(spark, sf).withColumn("contig", F.lit("MT")).withColumn("filters", F.col("FT"))
    return L.mask_sites(rows, derived(spark, sf, "bed")).select("s", "pos", "ref", "alt", _names("filters").alias("filters"))


# --- annotation ------------------------------------------------------------------------------------------------

def _resource(spark, sf, name):
    rows = derived(spark, sf, name)
    if name == "clinvar":
        rows = rows.withColumnsRenamed({"location": "GRCh38Location", "spdi": "Canonical SPDI",
                                        "label": "Germline classification"})
    make = {"gnomad": A.gnomad, "mitomap_poly": A.mitomap_polymorphisms, "mitomap_dis": A.mitomap_disease,
            "apogee": A.apogee, "hmtvar": A.hmtvar, "mitotip": A.mitotip, "helix": A.helix, "clinvar": A.clinvar,
            "haplo": A.haplogroup_variants}
    return make[name](rows)


def _resources(spark, sf):
    return [_resource(spark, sf, n) for n in A.RESOURCES]


def _call_keys(spark, sf):
    return derived(spark, sf, "calls").select(
        F.col("s").alias("SampleID"), F.col("pos").cast("string").alias("POS"), F.col("ref").alias("REF"),
        F.col("alt").alias("ALT"))


ANNOTATIONS = {
    "gnomad": ["gnomad_max_hl", "gnomad_af_hom", "gnomad_af_het"],
    "helix": ["helix_max_hl", "helix_af_hom", "helix_af_het"], "clinvar": ["clinvar_interp"],
    "mitomap_poly": ["mitomap_gbcnt", "mitomap_af"],
    "mitomap_dis": ["mitomap_status", "mitomap_plasmy", "mitomap_disease"], "apogee": ["apogee_class"],
    "mitotip": ["mitotip_class"], "hmtvar": ["hmtvar_class"],
}


def _annot(name, spark, sf):
    return A.annotated(_call_keys(spark, sf), [_resource(spark, sf, name)]).select(
        "SampleID", "POS", "REF", "ALT", *ANNOTATIONS[name])


for _name in ANNOTATIONS:
    QUERIES[f"annot_{_name}"] = partial(_annot, _name)


def _haplogroups(spark, sf):
    return derived(spark, sf, "samples").select("s", "haplogroup")


@query
def annot_haplogroup(spark, sf):
    rows = A.with_haplogroup(_call_keys(spark, sf), _haplogroups(spark, sf), "SampleID")
    out = A.look_up(rows, [_resource(spark, sf, "haplo")])
    return out.select("SampleID", "POS", "REF", "ALT", "Haplogroup", A.haplogroup_status().alias("status"),
                      A.haplogroup_status(exact_token=True).alias("token_status"))


@query
def annot_category(spark, sf):
    meta = derived(spark, sf, "samples").select("s", "category")
    rows = _call_keys(spark, sf).withColumn("SampleID", F.concat(F.lower("SampleID"), F.lit("-run1")))
    return A.with_category(rows, meta, "SampleID")


@query
def resources_merged(spark, sf):
    return A.merged_resources(*_resources(spark, sf)).select(
        "ref", "pos", "alt", F.col("gnomad.AF_hom").alias("gnomad"), F.col("helix.max_het").alias("helix"),
        F.col("clinvar.label").alias("clinvar"), F.col("mitotip.label").alias("mitotip"),
        F.col("hmtvar.label").alias("hmtvar"), F.col("haplo.groups").alias("groups"))


def _records(spark, sf):
    return derived(spark, sf, "records")


@query
def consequence_parse(spark, sf):
    return A.consequence_fields(_records(spark, sf)).select("SampleID", "POS", "REF", "ALT", *schema.CSQ_FIELDS)


@query
def format_tags(spark, sf):
    return A.format_by_tag(A.without_hard_filters(_records(spark, sf))).select(
        "SampleID", "POS", "REF", "ALT", "FILTER", "GT", "AD", "DP", "Heteroplasmy")


@query
def format_positional(spark, sf):
    return A.format_by_position(_records(spark, sf)).select(
        "SampleID", "POS", "REF", "ALT", "GT", "AD", "DP", "Heteroplasmy")


@query
def cohort_counts(spark, sf):
    return A.cohort_counts(A.format_by_tag(_records(spark, sf))).select(
        "SampleID", "variant_key", "in_cohort_AC", "Freq")


@query
def contaminated_out(spark, sf):
    status = derived(spark, sf, "samples").select("s", "contamination")
    return A.uncontaminated(_call_keys(spark, sf), status, "SampleID")


def _probands(spark, sf):
    return A.probands(derived(spark, sf, "samples").select("s", "category"))


@query
def proband_set(spark, sf):
    return _probands(spark, sf)


@query
def proband_filter(spark, sf):
    return A.of_probands(_call_keys(spark, sf), _probands(spark, sf), "SampleID")


@query
def proband_prefix(spark, sf):
    return A.of_probands(_call_keys(spark, sf), _probands(spark, sf), "SampleID", prefix=True)


@query
def proband_present(spark, sf):
    rows = A.of_probands(_records(spark, sf), _probands(spark, sf), "SampleID")
    return A.variants_with(rows, A.present(F.col("SAMPLE_DATA")), ["POS", "REF", "ALT"]).select(
        "SampleID", "POS", "REF", "ALT", "SAMPLE_DATA")


def _single(spark, sf):
    samples = derived(spark, sf, "samples")
    return single_prefilter(_records(spark, sf), _resources(spark, sf), samples.select("s", "haplogroup"),
                            samples.select("s", "contamination"))


@query
def prefilter_single(spark, sf):
    return _single(spark, sf)


def _final(prefilter, max_freq=100, disease_first=False):
    """The final list from stored candidates, as sorting reads its input twice."""
    return final_list(settled(A.keep_candidates(prefilter, max_freq), "candidates"), max_freq, disease_first)


@query
def final_single(spark, sf):
    return _final(_single(spark, sf))


def _cohort(spark, sf, probands=None):
    return cohort_prefilter(_records(spark, sf), _resources(spark, sf), probands)


@query
def prefilter_cohort(spark, sf):
    return _cohort(spark, sf)


@query
def final_cohort(spark, sf):
    return _final(_cohort(spark, sf), MAX_FREQ, disease_first=True)


@query
def final_disease(spark, sf):
    return _final(_cohort(spark, sf, _probands(spark, sf)), MAX_FREQ, disease_first=True)


@query
def cohort_site_report(spark, sf):
    """Sites of the cohort matrix with cell counts, artifact flag and resource values, rarest first."""
    found = _sites(spark, sf)
    counts = M.site_states(_clean(_entries(spark, sf)), derived(spark, sf, "coverage"), _n_samples(spark, sf))
    sites = counts.join(M.flag_artifacts(found, derived(spark, sf, "bed")).drop("contig"), M.SITE)
    keyed = sites.select(F.col("pos").cast("string").alias("POS"), F.col("ref").alias("REF"), F.col("alt").alias("ALT"),
                         "n_called", "n_hom_ref", "n_no_call", _names("filters").alias("filters"))
    out = A.annotated(keyed, _resources(spark, sf)).select(
        *keyed.columns, "gnomad_af_hom", "helix_af_hom", "mitomap_af", "mitomap_disease", "clinvar_interp")
    return out.orderBy(F.asc_nulls_last("gnomad_af_hom"), "POS", "REF", "ALT")


# --- variant expressions -----------------------------------------------------------------------------------------

def _loci(spark, sf):
    contig = (F.when(F.col("DP") % 5 == 0, "chrX").when(F.col("DP") % 5 == 1, "Y").when(F.col("DP") % 5 == 2, "chrM")
              .when(F.col("DP") % 5 == 3, "MT").otherwise("chr12"))
    return derived(spark, sf, "calls").select(
        "s", "pos", "ref", "alt", contig.alias("contig"), F.array("ref", "alt", F.concat("alt", F.lit("A"))).alias("alleles"))


@query
def variant_ids(spark, sf):
    c, p, a = F.col("contig"), F.col("pos"), F.col("alleles")
    return _loci(spark, sf).select(
        "s", "pos", V.ref_allele(a).alias("ref"), V.alt_allele(a).alias("alt"), V.plain_contig(c).alias("plain"),
        V.variant_id(c, p, a).alias("id"), V.variant_id(c, p, a, 8).alias("short_id"),
        F.array_join(V.variant_ids(c, p, a), ",").alias("ids"),
        F.array_join(V.variant_ids(c, p, a, 9), ",").alias("short_ids"),
        V.variant_key(p, F.col("ref"), F.col("alt")).alias("variant_key")).withColumnRenamed("plain", "contig")


@query
def variant_type(spark, sf):
    a = F.col("alleles")
    return _loci(spark, sf).select("s", "pos", "ref", "alt", V.variant_type(a).alias("kind"),
                                   V.start_pos(F.col("pos")).alias("first"), V.end_pos(F.col("pos"), a).alias("after"))


@query
def xpos(spark, sf):
    return _loci(spark, sf).select("s", "pos", "ref", "alt", V.contig_number(F.col("contig")).alias("number"),
                                   V.xpos(F.col("contig"), F.col("pos")).alias("xpos"))


# --- transcripts ------------------------------------------------------------------------------------------------

def _transcripts(spark, sf):
    """Variants with their distinct transcripts in an array and the most severe term.

    The shuffle carries the four numbers of a transcript; its fields are filled in afterwards.
    """
    terms = F.array(*[F.lit(t) for t in C.SEVERITY])
    none = F.lit(None).cast("string")
    fields = ", ".join(f"'{name}', {text}" for name, text in TRANSCRIPT_FIELDS.items())

    def full(t):
        def term(rank):
            return F.element_at(terms, t[rank] + 1)
        plain = ["transcript_id", "gene_id", "lof", "lof_flags", "biotype", "canonical", "hgvsc", "hgvsp",
                 "amino_acids", "protein_start"]
        return F.struct(
            *[t[f].alias(f) for f in plain], F.array(term("a"), term("b")).alias("consequence_terms"),
            F.array(F.struct(F.lit("Pfam").alias("db"), t["domain"].alias("name"))).alias("domains"),
            F.lit(1).alias("cdna_start"), F.lit(2).alias("cdna_end"), F.lit("aaA/aaC").alias("codons"),
            F.concat(F.lit("SYM"), t["gene_id"]).alias("gene_symbol"), none.alias("lof_filter"),
            F.lit("").alias("lof_info"), none.alias("polyphen_prediction"), F.lit("P1").alias("protein_id"),
            none.alias("sift_prediction"))
    codes = derived(spark, sf, "transcript_codes").groupBy("variant").agg(
        F.collect_list(F.struct("ln", "res", "fl", "st")).alias("xs"))
    rows = codes.select("variant", F.expr(f"sort_array(transform(xs, x -> named_struct({fields})))").alias("xs"))
    worst = F.array_min(F.transform("xs", lambda t: F.least(t["a"], t["b"])))
    return rows.select("variant", F.transform("xs", full).alias("transcripts"),
                       F.element_at(terms, worst + 1).alias("most_severe"))


def _ranked(spark, sf, **options):
    return _transcripts(spark, sf).select(
        "variant", C.ranked_transcripts(F.col("transcripts"), F.col("most_severe"), **options).alias("r"))


def _each_ranked(spark, sf, **options):
    """A row a transcript. The plain form of inline has Spark filter by the array first, which ranks all transcripts again; a real row has a rank."""
    return _ranked(spark, sf, **options).select("variant", F.inline_outer("r")).filter("transcript_rank is not null")


@query
def lof_flags(spark, sf):
    t = F.col("transcripts")
    return _transcripts(spark, sf).select(
        "variant", lof.variant_low_confidence(t).alias("low_confidence"), lof.variant_flagged(t).alias("flagged"),
        F.array_join(lof.low_confidence_genes(t), ",").alias("low_confidence_genes"),
        F.array_join(lof.flagged_genes(t), ",").alias("flagged_genes"))


@query
def lof_transcript_flags(spark, sf):
    return derived(spark, sf, "transcripts").select(
        "variant", "transcript_id", lof.transcript_low_confidence(F.col("lof")).alias("low_confidence"),
        lof.transcript_flagged(F.col("lof"), F.col("lof_flags")).alias("flagged"))


@query
def transcript_rank(spark, sf):
    return _each_ranked(spark, sf).select(
        "variant", "transcript_rank", "transcript_id", F.array_join("consequence_terms", ",").alias("terms"),
        "major_consequence", "major_consequence_rank", "category")


@query
def hgvs_format(spark, sf):
    return _each_ranked(spark, sf).select("variant", "transcript_id", "hgvs")


@query
def transcript_rank_noncoding(spark, sf):
    ranked = _each_ranked(spark, sf, coding=False, omit=["intergenic_variant", "intron_variant"])
    return ranked.select("variant", "transcript_rank", "transcript_id", "hgvs")


@query
def worst_transcript(spark, sf):
    return _ranked(spark, sf).select("variant", C.worst_transcript(F.col("r")).alias("w")).select("variant", "w.*")


@query
def consequence_json(spark, sf):
    rows = _transcripts(spark, sf).withColumn("r", C.ranked_transcripts(F.col("transcripts"), F.col("most_severe")))
    return rows.select("variant", C.gene_consequence_json(F.col("r"), C.gene_ids(F.col("r"))).alias("genes"),
                       C.transcript_consequence_json(F.col("r")).alias("transcripts"))


@query
def vep_sets(spark, sf):
    t = F.col("transcripts")
    ranked = C.ranked_transcripts(t, F.col("most_severe"))
    sets = {"terms": C.consequence_terms(t), "genes": C.gene_ids(t), "coding_genes": C.gene_ids(t, only_coding=True),
            "transcript_ids": C.transcript_ids(t), "domains": C.protein_domains(t),
            "ranked_domains": C.protein_domains_of_ranked(ranked)}
    return _transcripts(spark, sf).select("variant", *[F.array_join(v, ",").alias(n) for n, v in sets.items()])


# --- reads ------------------------------------------------------------------------------------------------------

@query
def read_subset(spark, sf):
    return R.on_contig(derived(spark, sf, "reads"), "chrM").select("qname", "contig", "mate_contig", "mate_unmapped")


@query
def read_revert(spark, sf):
    tags = F.create_map(F.lit("FT"), F.lit("x"), F.lit("NM"), F.col("mapq").cast("string"), F.lit("CO"), F.lit("y"))
    out = R.reverted(derived(spark, sf, "reads").withColumn("tags", tags))
    kept = F.array_join(F.map_keys("tags"), ","), F.array_join(F.map_values("tags"), ",")
    return out.select("qname", "library", "sum_qual", kept[0].alias("tag_names"), kept[1].alias("tag_values"))


@query
def merge_runs(spark, sf):
    reads = derived(spark, sf, "reads").select("qname", "library", "contig", "pos")
    return R.merged_runs(reads.filter("library = 'click'"), reads.filter("library <> 'click'"))


@query
def mark_duplicates(spark, sf):
    marked = templates.mark_duplicates(derived(spark, sf, "mates"))
    return marked.select("qname", "library", "contig", "five_prime", "is_primary", "is_duplicate")


@query
def duplicate_metrics(spark, sf):
    return R.duplicate_metrics(templates.mark_duplicates(derived(spark, sf, "mates")))


@query
def optical_copies(spark, sf):
    return templates.optical_copies(templates.templates(derived(spark, sf, "mates")))


@query
def library_metrics(spark, sf):
    return templates.library_metrics(derived(spark, sf, "mates"))


def _targets(spark):
    return spark.createDataFrame(TARGETS, "contig string, start int, end int")


def _depth(spark, sf, cap=None):
    return R.per_base_depth(R.good_quality(derived(spark, sf, "reads")), _targets(spark), cap)


@query
def per_base_depth(spark, sf):
    return _depth(spark, sf, cap=4)


@query
def wgs_summary(spark, sf):
    return R.coverage_summary(_depth(spark, sf, cap=100000))


def _ring_depth(spark, sf):
    whole = spark.createDataFrame([("chrM", 1, schema.CONTIG_LENGTH)], "contig string, start int, end int")
    return circular.circular_depth(R.good_quality(derived(spark, sf, "ring_reads")), whole)


@query
def circular_depth(spark, sf):
    return _ring_depth(spark, sf)


@query
def circular_depth_runs(spark, sf):
    return circular.depth_runs(_ring_depth(spark, sf))


def _template_depth(spark, sf, cap=None):
    width = F.col("end") - F.col("start")
    quals = F.transform(F.sequence(F.lit(0), width), lambda i: F.when(i % 31 != 0, (F.col("baseq") + i * i) % 41))
    marked = settled(templates.mark_duplicates(derived(spark, sf, "mates")), "marked")
    return R.template_depth(marked.withColumn("quals", quals), _targets(spark), cap=cap)


@query
def template_depth(spark, sf):
    return _template_depth(spark, sf)


@query
def coverage_shares(spark, sf):
    return R.coverage_shares(_template_depth(spark, sf, cap=3))


# --- documents -------------------------------------------------------------------------------------------------------

def _merge(operation, spark, sf):
    return D.apply_documents(derived(spark, sf, "stored"), derived(spark, sf, "incoming"), "id", operation,
                             ignore_errors=True)


for _name in D.OPERATIONS:
    QUERIES[f"doc_merge_{_name}"] = partial(_merge, _name)


@query
def doc_bulk_lines(spark, sf):
    docs = derived(spark, sf, "incoming").withColumnRenamed("name", "o.name")
    return D.bulk_lines(docs, "orders", "id", "index")


@query
def doc_bulk_upsert(spark, sf):
    return D.bulk_lines(derived(spark, sf, "incoming"), "orders", "id", "upsert")


@query
def field_name_codec(spark, sf):
    raw = F.concat(F.when(F.col("page_id") % 3 == 0, "_").when(F.col("page_id") % 3 == 1, "$").otherwise(""), "url",
                   F.lit("#a$(b)[c]{d}*,_$dot$_"))
    code = names.encoded_text(F.col("raw"))
    return load(spark, sf, "pages").select("page_id", raw.alias("raw")).select(
        "page_id", "raw", code.alias("code"), names.decoded_text(code).alias("back"))
