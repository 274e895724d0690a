"""Ranking and rendering of VEP transcript consequences held as an array of structs."""

from pyspark.sql import Column, functions as F

from chondria.functions.casts import bound

# --- fixed values ------------------------------------------------------------------------------

# Consequence terms by severity, worst first; the index is the rank.
SEVERITY = [
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained",
    "frameshift_variant", "stop_lost", "start_lost", "initiator_codon_variant",
    "transcript_amplification", "inframe_insertion", "inframe_deletion", "missense_variant",
    "protein_altering_variant", "splice_region_variant", "incomplete_terminal_codon_variant",
    "start_retained_variant", "stop_retained_variant", "synonymous_variant",
    "coding_sequence_variant", "mature_miRNA_variant", "5_prime_UTR_variant", "3_prime_UTR_variant",
    "non_coding_transcript_exon_variant", "non_coding_exon_variant", "intron_variant",
    "NMD_transcript_variant", "non_coding_transcript_variant", "nc_transcript_variant",
    "upstream_gene_variant", "downstream_gene_variant", "TFBS_ablation", "TFBS_amplification",
    "TF_binding_site_variant", "regulatory_region_ablation", "regulatory_region_amplification",
    "feature_elongation", "regulatory_region_variant", "feature_truncation", "intergenic_variant",
]
OMITTED_TERMS = ["upstream_gene_variant", "downstream_gene_variant"]
SPLICE_TERMS = ["splice_donor_variant", "splice_acceptor_variant", "splice_region_variant"]

# One-letter amino-acid codes and their three-letter names.
AMINO_ACIDS = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly", "H": "His", "I": "Ile",
    "K": "Lys", "L": "Leu", "M": "Met", "N": "Asn", "P": "Pro", "Q": "Gln", "R": "Arg", "S": "Ser",
    "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr", "X": "Ter", "*": "Ter", "U": "Sec",
}

BASE_FIELDS = ["biotype", "canonical", "cdna_start", "cdna_end", "codons", "gene_id", "gene_symbol",
               "hgvsc", "hgvsp", "transcript_id"]
CODING_FIELDS = ["amino_acids", "lof", "lof_filter", "lof_flags", "lof_info", "polyphen_prediction",
                 "protein_id", "protein_start", "sift_prediction"]

WORST_FIELDS = {
    "biotype": "string", "canonical": "int", "category": "string", "cdna_start": "int", "cdna_end": "int",
    "codons": "string", "gene_id": "string", "gene_symbol": "string", "hgvs": "string", "hgvsc": "string",
    "major_consequence": "string", "major_consequence_rank": "int", "transcript_id": "string",
}
WORST_CODING_FIELDS = {
    "amino_acids": "string", "domains": "string", "hgvsp": "string", "lof": "string", "lof_flags": "string",
    "lof_filter": "string", "lof_info": "string", "polyphen_prediction": "string", "protein_id": "string",
    "sift_prediction": "string",
}


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _lookup(pairs: dict, key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.try_element_at(table, key)


def _text_set(values: Column) -> Column:
    return F.sort_array(F.array_distinct(values))


def severity_rank(term: Column) -> Column:
    """0 for the worst term, NULL for an unknown one."""
    place = F.array_position(_strings(SEVERITY), term).cast("int")
    return F.when(place > 0, place - 1)


def consequence_terms(transcripts: Column) -> Column:
    return _text_set(F.flatten(F.transform(transcripts, lambda t: t["consequence_terms"])))


def gene_ids(transcripts: Column, only_coding: bool = False) -> Column:
    if only_coding:
        transcripts = F.filter(transcripts, lambda t: t["biotype"].eqNullSafe("protein_coding"))
    return _text_set(F.transform(transcripts, lambda t: t["gene_id"]))


def transcript_ids(transcripts: Column) -> Column:
    return _text_set(F.transform(transcripts, lambda t: t["transcript_id"]))


def _domain_names(domains: Column) -> Column:
    return F.transform(domains, lambda d: F.concat(d["db"], F.lit(":"), d["name"]))


def protein_domains(transcripts: Column) -> Column:
    """Distinct ``db:name`` texts; a transcript without domains adds none."""
    known = F.filter(transcripts, lambda t: t["domains"].isNotNull())
    return _text_set(F.flatten(F.transform(known, lambda t: _domain_names(t["domains"]))))


def protein_domains_of_ranked(ranked: Column) -> Column:
    """As :func:`protein_domains`, over the output of :func:`ranked_transcripts`."""
    known = F.filter(ranked, lambda t: t["domains"].isNotNull())
    return _text_set(F.flatten(F.transform(known, lambda t: t["domains"])))


PLACES = 1 << 31        # more than any array can hold


def _by_code(values: Column, code: Column) -> Column:
    """Item of ``values`` whose place is in a code ``rank * PLACES + place``."""
    return F.get(values, F.pmod(code, F.lit(PLACES)).cast("int"))


def _worst_code(terms: Column) -> Column:
    """Rank and place of the worst term in one number; unknown terms come last, equal ranks keep the array order."""
    return F.array_min(F.transform(terms, lambda t, i: F.coalesce(severity_rank(t), F.lit(len(SEVERITY)))
                                   .cast("long") * F.lit(PLACES) + i))


def major_term(terms: Column) -> Column:
    """Worst term of an array, NULL for an empty one."""
    return bound(F.struct(terms.alias("t"), _worst_code(terms).alias("w")), lambda v: _by_code(v["t"], v["w"]))


def category(rank: Column) -> Column:
    """lof, missense, synonymous or other; NULL when the rank is unknown."""
    at = {term: place for place, term in enumerate(SEVERITY)}
    return F.when(rank.isNotNull(),
                  F.when(rank <= at["frameshift_variant"], "lof")
                  .when(rank <= at["missense_variant"], "missense")
                  .when(rank <= at["synonymous_variant"], "synonymous")
                  .otherwise("other"))


def _after_colon(text: Column) -> Column:
    return F.element_at(F.split(text, ":"), -1)


def formatted_hgvs(hgvsc: Column, hgvsp: Column, major: Column, amino_acids: Column, protein_start: Column) -> Column:
    """Coding change for splice terms or without a protein change, else the protein change.

    A synonymous protein change is written ``p.<aa><position><aa>``; it is NULL when ``amino_acids`` is no
    single known letter.
    """
    letters = _lookup(AMINO_ACIDS, amino_acids)
    silent = hgvsp.contains("=") | hgvsp.contains("%3D")
    use_coding = hgvsp.isNull() | major.isin(SPLICE_TERMS)
    text = (F.when(use_coding, _after_colon(hgvsc))
            .when(silent, F.concat(F.lit("p."), letters, protein_start.cast("string"), letters))
            .otherwise(_after_colon(hgvsp)))
    return F.when(use_coding.isNotNull(), text)


def ranked_transcripts(transcripts: Column, most_severe: Column, coding: bool = True,
                       omit: list[str] | None = None) -> Column:
    """Transcripts with derived fields, ordered coding, most severe, canonical first.

    Terms in ``omit`` are removed, and transcripts left without a term are dropped. Each element gains
    ``consequence_terms, major_consequence, category, hgvs, major_consequence_rank, transcript_rank`` and,
    with ``coding``, the list of ``domains``.
    """
    omitted = _strings(OMITTED_TERMS if omit is None else omit).cast("array<string>")

    def reduced(t):
        keep = BASE_FIELDS + (CODING_FIELDS if coding else [])
        return F.struct(
            *[t[f].alias(f) for f in keep],
            F.filter(t["consequence_terms"], lambda x: ~F.array_contains(omitted, x)).alias("consequence_terms"),
            _domain_names(t["domains"]).alias("domains"),
            t["consequence_terms"].alias("_terms"), _worst_code(t["consequence_terms"]).alias("_worst"),
            t["amino_acids"].alias("_aa"), t["protein_start"].alias("_at"))

    def described(t):
        major, rank = _by_code(t["_terms"], t["_worst"]), F.floor(t["_worst"] / F.lit(PLACES)).cast("int")
        rank = F.when(rank < len(SEVERITY), rank)
        keep = BASE_FIELDS + (CODING_FIELDS + ["domains"] if coding else [])
        hgvs = formatted_hgvs(t["hgvsc"], t["hgvsp"], major, t["_aa"], t["_at"])
        return [*[t[f].alias(f) for f in keep if coding or f != "hgvsp"],
                t["consequence_terms"].alias("consequence_terms"), major.alias("major_consequence"),
                category(rank).alias("category"), hgvs.alias("hgvs"), rank.alias("major_consequence_rank")]

    def order(t, most_severe):
        steps = [(F.coalesce(t["biotype"], F.lit("")) == "protein_coding", 4),
                 (F.coalesce(F.array_contains(t["consequence_terms"], most_severe), F.lit(False)), 2),
                 (F.coalesce(t["canonical"], F.lit(0)) == 1, 1)]
        return sum((F.when(flag, 0).otherwise(weight) for flag, weight in steps), F.lit(1))

    def ranked(v):
        codes = F.sort_array(F.transform(v["t"], lambda t, i: order(t, v["worst"]).cast("long") * F.lit(PLACES) + i))
        return F.transform(codes, lambda c, i: bound(
            _by_code(v["t"], c), lambda t: F.struct(*described(t), i.alias("transcript_rank"))))
    kept = F.filter(F.transform(transcripts, reduced), lambda t: F.size(t["consequence_terms"]) > 0)
    return bound(F.struct(kept.alias("t"), most_severe.alias("worst")), ranked)


def _json_object(pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def gene_consequence_json(ranked: Column, genes: Column) -> Column:
    """``{"gene":"worst term",...}`` with the first ranked transcript of each gene."""
    def pairs(v):
        def pair(g):
            first = F.get(F.filter(v["r"], lambda t: t["gene_id"] == g), F.lit(0))
            return F.concat(F.lit('"'), g, F.lit('":"'), first["major_consequence"], F.lit('"'))
        return _json_object(F.transform(v["g"], pair))
    return bound(F.struct(ranked.alias("r"), genes.alias("g")), pairs)


def transcript_consequence_json(ranked: Column) -> Column:
    """``{"transcript": "worst term",...}``; this form has a blank after the colon."""
    return _json_object(F.transform(ranked, lambda t: F.concat(
        F.lit('"'), t["transcript_id"], F.lit('": "'), t["major_consequence"], F.lit('"'))))


def worst_transcript(ranked: Column, coding: bool = True) -> Column:
    """First ranked transcript as a struct of fixed fields; an empty array gives a struct of NULLs."""
    fields = {**WORST_FIELDS, **(WORST_CODING_FIELDS if coding else {})}

    def reduced(first):
        def value(name, kind):
            v = F.array_join(_text_set(first["domains"]), ",") if name == "domains" else first[name]
            return v.cast(kind).alias(name)
        return F.struct(*[value(n, k) for n, k in fields.items()])
    return F.when(ranked.isNotNull(), bound(F.get(ranked, F.lit(0)), reduced))
