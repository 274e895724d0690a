"""Variant identity: alleles, contigs, ids, types and genome-wide positions."""

from pyspark.sql import Column, functions as F


def _cut(text: Column, max_length: int | None) -> Column:
    return text if max_length is None else F.substring(text, 1, max_length)


def ref_allele(alleles: Column) -> Column:
    return F.get(alleles, F.lit(0))


def alt_allele(alleles: Column) -> Column:
    return F.get(alleles, F.lit(1))


def plain_contig(contig: Column) -> Column:
    """Contig name without a leading ``chr``."""
    return F.regexp_replace(contig, "^chr", "")


def contig_number(contig: Column) -> Column:
    """X is 23, Y is 24, any name starting with M is 25, other names are read as numbers."""
    name = plain_contig(contig)
    return (F.when(name == "X", 23).when(name == "Y", 24).when(name.startswith("M"), 25)
            .otherwise(name.try_cast("int")))


def xpos(contig: Column, pos: Column) -> Column:
    """One sortable long per locus."""
    return contig_number(contig).cast("long") * F.lit(10 ** 9) + pos


def variant_id(contig: Column, pos: Column, alleles: Column, max_length: int | None = None) -> Column:
    """``contig-pos-ref-alt`` of a bi-allelic record, contig without ``chr``."""
    parts = [plain_contig(contig), pos.cast("string"), ref_allele(alleles), alt_allele(alleles)]
    return _cut(F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit("-"), parts[3]), max_length)


def variant_ids(contig: Column, pos: Column, alleles: Column, max_length: int | None = None) -> Column:
    """One id per alternate allele; the contig name is kept as it is."""
    stem = F.concat(contig, F.lit("-"), pos.cast("string"), F.lit("-"), ref_allele(alleles), F.lit("-"))
    alts = F.slice(alleles, F.lit(2), F.greatest(F.size(alleles) - 1, F.lit(0)))
    return F.transform(alts, lambda alt: _cut(F.concat(stem, alt), max_length))


def variant_type(alleles: Column) -> Column:
    """D(eletion), I(nsertion), M(ulti-base) or S(ingle base)."""
    ref, alt = F.length(ref_allele(alleles)), F.length(alt_allele(alleles))
    kind = F.when(ref > alt, "D").when(ref < alt, "I").when(ref > 1, "M").otherwise("S")
    return F.when(ref.isNotNull() & alt.isNotNull(), kind)


def start_pos(pos: Column) -> Column:
    return pos


def end_pos(pos: Column, alleles: Column) -> Column:
    """First position after the reference allele."""
    return pos + F.length(ref_allele(alleles))


def variant_key(pos: Column, ref: Column, alt: Column) -> Column:
    """``POS:REF:ALT``."""
    return F.concat(pos.cast("string"), F.lit(":"), ref, F.lit(":"), alt)
