"""Loss-of-function flags over one transcript or over a variant's transcript array.

An annotated transcript has a non-empty ``lof``; ``HC`` means high confidence.
"""

from pyspark.sql import Column, functions as F

from chondria.functions.casts import bound


def _annotated(transcripts: Column) -> Column:
    return F.filter(transcripts, lambda t: t["lof"] != "")


def _every(transcripts: Column, weak) -> Column:
    return bound(_annotated(transcripts), lambda hits: (F.size(hits) > 0) & F.forall(hits, weak))


def _genes_where_every(transcripts: Column, weak) -> Column:
    """Genes of annotated transcripts, less those with an annotated transcript that is not weak."""
    def genes(hits):
        named = F.filter(F.transform(hits, lambda t: t["gene_id"]), lambda g: g.isNotNull())
        sound = F.transform(F.filter(hits, lambda t: ~F.coalesce(weak(t), F.lit(False))), lambda t: t["gene_id"])
        return F.sort_array(F.array_except(named, sound))
    return bound(_annotated(transcripts), genes)


def _low_confidence(t: Column) -> Column:
    return t["lof"] != "HC"


def _flagged(t: Column) -> Column:
    return t["lof_flags"] != ""


def transcript_low_confidence(lof: Column) -> Column:
    return F.coalesce((lof != "") & (lof != "HC"), F.lit(False))


def transcript_flagged(lof: Column, lof_flags: Column) -> Column:
    return F.coalesce((lof != "") & (lof_flags != ""), F.lit(False))


def variant_low_confidence(transcripts: Column) -> Column:
    """The variant has annotated transcripts and none is high confidence."""
    return _every(transcripts, _low_confidence)


def variant_flagged(transcripts: Column) -> Column:
    """The variant has annotated transcripts and all carry flags."""
    return _every(transcripts, _flagged)


def low_confidence_genes(transcripts: Column) -> Column:
    return _genes_where_every(transcripts, _low_confidence)


def flagged_genes(transcripts: Column) -> Column:
    return _genes_where_every(transcripts, _flagged)
