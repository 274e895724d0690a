"""Annotation of variants: record parsing, resource lookups, cohort counts, filters and order.

Resource tables are normalised to string keys ``ref, pos, alt`` and one struct column each, then merged into a
single table with one row per variant, so that annotating costs one join however many resources there are.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from chondria import schema
from chondria.functions.casts import bound, number
from chondria.functions.cells import empty_cell, known_cells, known_items
from chondria.functions.variant import variant_key
from chondria.operators.joins import keep_listed, lookup_join, own_lookup, prefixes
from chondria.sources.calls import info_value, tag_value

KEY = ["ref", "pos", "alt"]


# --- records ---------------------------------------------------------------------------------------

def without_hard_filters(records: DataFrame) -> DataFrame:
    """Records whose FILTER names none of the hard filters; a missing FILTER is kept."""
    return records.filter(~F.coalesce(F.col("FILTER").rlike(schema.HARD_FILTERS), F.lit(False)))


def consequence_fields(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Named sub-fields of the first consequence in ``CSQ=``; short or absent ones are NULL."""
    first = F.get(F.split(info_value(F.col("INFO"), "CSQ"), ","), F.lit(0))
    names = schema.CSQ_FIELDS if keep is None else keep
    split = records.withColumn("_csq", F.split(first, r"\|"))
    return split.withColumns({n: F.get("_csq", F.lit(schema.CSQ_FIELDS.index(n))) for n in names}).drop("_csq")


def _filled(cell: Column) -> Column:
    """False for a cell of dots alone, one a name, by a comparison of bytes; very long ones count as filled."""
    return ~(F.lit(".:" * 32).startswith(cell) & cell.endswith("."))


def format_by_tag(rows: DataFrame) -> DataFrame:
    """``GT, AD, DP`` and ``Heteroplasmy`` (AF, else HL) of each sample cell, by the record's own layout.

    Cells of dots alone, most of a cohort's, have no value whatever the layout, so they are not split.
    """
    filled = _filled(F.col("SAMPLE_DATA"))
    split = rows.withColumns({"_layout": F.split(F.when(filled, F.col("FORMAT")), ":"), "_cells": F.split(F.when(filled, F.col("SAMPLE_DATA")), ":")})

    def tag(name):
        return tag_value(F.col("_layout"), F.col("_cells"), name)
    picked = split.withColumns({"_gt": tag("GT"), "_ad": tag("AD"), "_dp": tag("DP"),
                                "Heteroplasmy": F.coalesce(number(tag("AF")), number(tag("HL")))})
    known = {n: F.when(F.col(c) != ".", F.col(c)) for n, c in (("GT", "_gt"), ("AD", "_ad"), ("DP", "_dp"))}
    return picked.withColumns(known).drop("_layout", "_cells", "_gt", "_ad", "_dp")


def format_by_position(rows: DataFrame) -> DataFrame:
    """As :func:`format_by_tag` for cells that start with GT, AD, AF, DP whatever the layout says."""
    cells = F.split("SAMPLE_DATA", ":", 5)
    at = [F.get(cells, F.lit(i)) for i in range(4)]
    return rows.withColumns({"GT": at[0], "AD": at[1], "DP": number(at[3]).cast("string"),
                             "Heteroplasmy": number(at[2])})


def long_records(records: DataFrame, samples: DataFrame, per_file: bool = False, known: bool = False) -> DataFrame:
    """One row per sample and record: ``SampleID`` and ``SAMPLE_DATA`` beside the fixed columns. ``cells`` is an array, or the tab separated text of a line.

    With ``known``, cells that hold a dot for each name of their layout, and so no value, are left out before cells become rows.
    The names of one header are broadcast whatever the size of the files: they are no wider than one of the records, and the cells, every
    sample at every site, stay where they are read.
    """
    keys = ["file", "idx"] if per_file else ["idx"]
    kept = [c for c in records.columns if c != "cells"]
    text = records.schema["cells"].dataType == T.StringType()
    if known:
        # A column named in a lambda is computed again for each item, so the dots come in as a value.
        cells = known_cells(F.col("cells"), F.col("FORMAT")) if text else bound(empty_cell(F.col("FORMAT")), lambda empty: known_items(F.col("cells"), empty))
        rows = records.select(*kept, F.inline_outer(cells))
    else:
        rows = records.select(*kept, F.posexplode_outer(F.split("cells", "\t") if text else "cells").alias("idx", "SAMPLE_DATA"))
    # The plain forms have Spark filter by the array first, which computes it again; the join drops the rows that the outer ones add.
    named = samples.select(*keys, "SampleID")
    return (lookup_join(rows, named, keys, "inner") if per_file else rows.join(F.broadcast(named), keys)).drop("idx")


def carriers(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("Heteroplasmy") > 0)


def present(cell: Column) -> Column:
    """Whether a text cell counts as a call: not empty or ``.``, and no reference or missing genotype."""
    text = F.trim(cell)
    first = F.substring_index(text, ":", 1)
    genotype = first.contains("/") | first.contains("|")
    some = F.when(genotype, ~first.isin("0/0", "0|0", "./.")).otherwise(F.lit(True))
    return F.coalesce(~text.isin("", ".") & some, F.lit(False))


# --- samples ---------------------------------------------------------------------------------------

def probands(metadata: DataFrame) -> DataFrame:
    """Distinct non-empty sample ids of the category proband."""
    rows = metadata.filter((F.lower("category") == "proband") & (F.trim("s") != ""))
    if rows.isEmpty():
        raise ValueError("the metadata name no proband")
    return rows.select(F.trim("s").alias("s")).distinct()


def of_probands(rows: DataFrame, ids: DataFrame, key: str, prefix: bool = False) -> DataFrame:
    """Rows of proband samples. With ``prefix`` a sample whose name, up to ``:``, starts with a proband id counts."""
    if not prefix:
        return keep_listed(rows, ids.select(F.col("s").alias(key)), key)
    names = rows.select(key).distinct()
    pieces = names.select(key, F.explode(prefixes(F.substring_index(key, ":", 1))).alias("s"))
    return keep_listed(rows, pieces.join(ids, "s", "left_semi").select(key), key)


def variants_with(rows: DataFrame, is_call: Column, site: list[str]) -> DataFrame:
    """Rows of the sites where some row is a call."""
    hit = rows.groupBy(*site).agg(F.max(is_call).alias("_any")).filter("_any").select(*site)
    return lookup_join(rows, hit, site, "left_semi")


def uncontaminated(rows: DataFrame, status: DataFrame, key: str) -> DataFrame:
    """Rows of samples whose ``contamination`` is not YES."""
    bad = status.filter(F.upper("contamination") == "YES").select(F.col("s").alias(key))
    return keep_listed(rows, bad, key, listed=False)


def last_rows(table: DataFrame, key: Column, value: Column, name: str) -> DataFrame:
    """One row a key, with the value of its last row in the table's order."""
    placed = table.select(key, value.alias(name), F.monotonically_increasing_id().alias("_place"))
    return placed.groupBy(placed.columns[0]).agg(F.max_by(name, "_place").alias(name))


def with_haplogroup(rows: DataFrame, haplogroups: DataFrame, key: str) -> DataFrame:
    """Adds ``Haplogroup`` from ``(s, haplogroup)``; of a repeated sample the last row counts."""
    table = last_rows(haplogroups, F.col("s").alias(key), F.col("haplogroup"), "Haplogroup")
    return lookup_join(rows, table, [key])


def with_category(rows: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Adds ``Sample_Category``: the metadata id equals the sample id up to its first ``-``, in any case; the last row counts."""
    table = last_rows(metadata, F.lower("s").alias("_id"), F.col("category"), "Sample_Category")
    named = rows.withColumn("_id", F.lower(F.substring_index(key, "-", 1)))
    return lookup_join(named, table, ["_id"]).drop("_id")


# --- resource tables: ref, pos, alt, one struct, and ``ord`` as the order of rows -------------------------

RESOURCES = {
    "gnomad": "struct<max_observed_heteroplasmy:string,AF_hom:string,AF_het:string>",
    "mitomap_poly": "struct<gbcnt:string>",
    "mitomap_dis": "struct<status:string,homoplasmy:string,heteroplasmy:string,disease:string>",
    "apogee": "struct<APOGEE1:string,APOGEE2:string>", "hmtvar": "struct<label:string>",
    "mitotip": "struct<label:string>", "helix": "struct<max_het:double,AF_hom:double,AF_het:double>",
    "clinvar": "struct<label:string>", "haplo": "struct<groups:string>",
}


def _resource(rows: DataFrame, name: str, key: list, values: dict) -> DataFrame:
    cols = [F.col(k) if isinstance(k, str) else k for k in key]
    struct = F.struct(*[v.alias(n) for n, v in values.items()])
    return rows.select(*[c.cast("string").alias(k) for c, k in zip(cols, KEY)], "ord",
                       *[(struct if n == name else F.lit(None).cast(kind)).alias(n) for n, kind in RESOURCES.items()])


def gnomad(rows: DataFrame) -> DataFrame:
    return _resource(rows, "gnomad", ["ref", "position", "alt"], {
        n: F.col(n) for n in ("max_observed_heteroplasmy", "AF_hom", "AF_het")})


def mitomap_polymorphisms(rows: DataFrame) -> DataFrame:
    return _resource(rows, "mitomap_poly", ["ref", "pos", "alt"], {"gbcnt": F.col("gbcnt")})


def mitomap_disease(rows: DataFrame) -> DataFrame:
    return _resource(rows, "mitomap_dis", ["ref", "pos", "alt"], {
        n: F.col(n) for n in ("status", "homoplasmy", "heteroplasmy", "disease")})


def apogee(rows: DataFrame) -> DataFrame:
    return _resource(rows, "apogee", ["Ref", "Start", "Alt"], {n: F.col(n) for n in ("APOGEE1", "APOGEE2")})


def hmtvar(rows: DataFrame, path: str = "$.pathogenicity") -> DataFrame:
    return _resource(rows, "hmtvar", ["REF", "POS", "ALT"], {"label": F.get_json_object("HmtVar", path)})


def mitotip(rows: DataFrame) -> DataFrame:
    labels = F.create_map(*[F.lit(x) for pair in schema.MITOTIP_LABELS.items() for x in pair])
    return _resource(rows, "mitotip", ["rCRS", "Position", "Alt"],
                     {"label": F.try_element_at(labels, F.col("Quartile"))})


def helix(rows: DataFrame) -> DataFrame:
    """Bi-allelic rows only. The highest level is 1 for a variant seen homoplasmic, else ``max_ARF``, else 0."""
    rows = rows.filter(F.regexp_count("alleles", F.lit(",")) == 1)
    quoted = F.split("alleles", '"')
    hom, most = F.coalesce(number(F.col("AF_hom")), F.lit(0.0)), F.coalesce(number(F.col("max_ARF")), F.lit(0.0))
    return _resource(rows, "helix", [F.get(quoted, F.lit(1)), F.get(F.split("locus", "chrM:"), F.lit(1)),
                                     F.get(quoted, F.lit(3))],
                     {"max_het": F.when(hom > 0, 1.0).otherwise(most), "AF_hom": hom,
                      "AF_het": number(F.col("AF_het"))})


def clinvar(rows: DataFrame, excluded: list[str] | None = None) -> DataFrame:
    """Single-base substitutions; rows with an excluded label are left out, rows without a label are kept."""
    spdi = F.split("Canonical SPDI", ":")
    ref, alt = F.get(spdi, F.lit(2)), F.get(spdi, F.lit(3))
    label = F.col("Germline classification")
    rows = rows.filter((F.length(ref) == 1) & (F.length(alt) == 1) & (ref != alt))
    for name in [schema.CONFLICTING] if excluded is None else excluded:
        rows = rows.filter(~label.eqNullSafe(F.lit(name)))
    return _resource(rows, "clinvar", [ref, F.col("GRCh38Location"), alt], {"label": label})


def haplogroup_variants(rows: DataFrame) -> DataFrame:
    """``Variant`` is REF, POS and ALT in one word."""
    word = r"^(\D+)(\d+)(\D+)$"
    rows = rows.filter(F.col("Variant").rlike(word))
    return _resource(rows, "haplo", [F.regexp_extract("Variant", word, i) for i in (1, 2, 3)],
                     {"groups": F.lower("Assoc_haplogroups")})


def merged_resources(*tables: DataFrame) -> DataFrame:
    """One row per variant with a struct per resource, NULL where the resource lacks the variant.

    Within a resource the last row of a variant wins. One aggregation serves all resources.
    """
    last = [F.max_by(n, F.when(F.col(n).isNotNull(), F.col("ord"))).alias(n) for n in RESOURCES]
    return reduce(DataFrame.union, tables).groupBy(*KEY).agg(*last)


def look_up(rows: DataFrame, tables: list[DataFrame] | DataFrame) -> DataFrame:
    """Joins resource tables, or their stored :func:`merged_resources`, to rows with string columns ``REF, POS, ALT``."""
    table = tables if isinstance(tables, DataFrame) else merged_resources(*tables)
    table = table.withColumnsRenamed({"ref": "REF", "pos": "POS", "alt": "ALT"})
    return lookup_join(rows, table, ["REF", "POS", "ALT"])


def _found(name: str, field: str, default) -> Column:
    """Field of a matched resource; ``default`` only when the variant is not in it."""
    return F.when(F.col(name).isNull(), default).otherwise(F.col(name)[field])


def _or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def population_columns() -> dict[str, Column]:
    zero = F.lit("0")
    return {
        "gnomad_max_hl": _found("gnomad", "max_observed_heteroplasmy", zero),
        "gnomad_af_hom": number(_found("gnomad", "AF_hom", zero)),
        "gnomad_af_het": number(_found("gnomad", "AF_het", zero)),
        "helix_max_hl": _found("helix", "max_het", F.lit(0.0)),
        "helix_af_hom": _found("helix", "AF_hom", F.lit(0.0)),
        "helix_af_het": _found("helix", "AF_het", F.lit(0.0)),
        "mitomap_gbcnt": _found("mitomap_poly", "gbcnt", zero),
        "mitomap_af": number(_found("mitomap_poly", "gbcnt", zero)) / F.lit(schema.MITOMAP_GENOMES),
    }


def clinical_columns() -> dict[str, Column]:
    hom, het = (_or_blank(_found("mitomap_dis", f, "")) for f in ("homoplasmy", "heteroplasmy"))
    both = [_or_blank(_found("apogee", f, "")) for f in ("APOGEE1", "APOGEE2")]
    return {
        "clinvar_interp": _found("clinvar", "label", ""),
        "mitomap_status": _found("mitomap_dis", "status", ""),
        "mitomap_plasmy": F.when((hom != "") | (het != ""), F.concat_ws("/", hom, het)).otherwise(""),
        "mitomap_disease": _found("mitomap_dis", "disease", ""),
        "apogee_class": F.when(F.col("apogee").isNull(), "").otherwise(F.concat_ws("/", *both)),
        "mitotip_class": _or_blank(_found("mitotip", "label", "")),
        "hmtvar_class": _or_blank(_found("hmtvar", "label", "")),
    }


def haplogroup_status(exact_token: bool = False) -> Column:
    """Whether the variant marks the sample's haplogroup, another one, or none.

    The haplogroup is searched as text in the list; ``exact_token`` compares whole list items.
    """
    groups, own = F.col("haplo")["groups"], F.lower("Haplogroup")
    same = F.array_contains(F.split(groups, r"\s*,\s*"), own) if exact_token else groups.contains(own)
    return (F.when(_or_blank(groups) == "", "not_haplo_var")
            .when(F.coalesce(same, F.lit(False)), "haplo_var_match").otherwise("haplo_var_diff_haplo"))


def annotated(rows: DataFrame, resources: list[DataFrame] | DataFrame | None) -> DataFrame:
    """Rows with the population and clinical columns of the resource tables, and their haplogroup status if known. Without tables the rows have looked them up."""
    out = (rows if resources is None else look_up(rows, resources)).withColumns({**population_columns(), **clinical_columns()})
    if "Haplogroup" in out.columns:
        out = out.withColumn("Haplogroup_Var_Status", haplogroup_status())
    return out.drop(*RESOURCES)


# --- cohort counts, filters and order ---------------------------------------------------------------------

def cohort_counts(rows: DataFrame, count_all_rows: bool = False, resources: list[DataFrame] | DataFrame | None = None) -> DataFrame:
    """Adds ``variant_key``, ``in_cohort_AC`` per variant and ``Freq`` per sample.

    Counts carriers, or every row with ``count_all_rows``. The counts combine on the map side and are joined back as lookups. The ``resources`` of
    :func:`look_up` are joined to the variants, so that the wide rows are shuffled once for both. The counts of the samples, two short values each, are
    broadcast whatever their number: a shuffle for them would move the wide rows again.
    """
    key, site = variant_key(F.col("POS"), F.col("REF"), F.col("ALT")), ["POS", "REF", "ALT"]
    counted = F.lit(True) if count_all_rows else F.col("Heteroplasmy") > 0
    # Alleles that hold the key's separator may share a key.
    variants = rows.groupBy(*site).agg(F.count_if(counted).alias("_n")).withColumn("variant_key", key)
    variants = variants.select(*site, F.sum("_n").over(Window.partitionBy("variant_key")).alias("in_cohort_AC"))
    samples = rows.groupBy("SampleID").agg(F.count_if(counted).alias("Freq"))
    out = own_lookup(rows, variants if resources is None else look_up(variants, resources), site)
    return own_lookup(out, F.broadcast(samples), ["SampleID"]).withColumn("variant_key", key)


def completed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns`` in order; absent ones are NULL."""
    return rows.select([F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def keep_candidates(rows: DataFrame, max_freq: int = 100, max_af: float = 0.01, min_level: float = 0.05) -> DataFrame:
    """Rare, not silent, heteroplasmic enough, not benign; a sample's marker variants are left out where known."""
    rare = [F.col(c) < max_af for c in ("gnomad_af_hom", "helix_af_hom", "mitomap_af")]
    keep = (rare[0] & rare[1] & rare[2]
            & ~F.col("Consequence").eqNullSafe("synonymous_variant")
            & (F.coalesce(number(F.col("Freq").cast("string")), F.lit(0.0)) < max_freq)
            & (F.col("Heteroplasmy") > min_level)
            & ~F.coalesce(F.col("clinvar_interp"), F.lit("")).isin(schema.BENIGN))
    if "Haplogroup_Var_Status" in rows.columns:
        keep = keep & ~F.col("Haplogroup_Var_Status").eqNullSafe("haplo_var_match")
    return rows.filter(keep)


def list_order(rows: DataFrame, disease_first: bool) -> list[Column]:
    """Rarest first, optionally after variants with a MITOMAP disease; ties by variant and sample."""
    sample = "SampleID" if "SampleID" in rows.columns else "SAMPLE_ID"
    lead = [(_or_blank(F.col("mitomap_disease")) != "").desc()] if disease_first else []
    return lead + [F.asc_nulls_last(c) for c in ("gnomad_af_hom", "helix_af_hom", "mitomap_af")] + [
        F.asc("POS"), F.asc("REF"), F.asc("ALT"), F.asc(sample)]
