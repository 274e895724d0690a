"""Exact de-duplication by two-pass Bloom filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chondria.llm import bits
from chondria.llm.common import SPACE, row_of, stored, text_of, unpacked


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with ``text_sha256``, ``keep_id``, ``group_size`` and ``kept`` added.

    Texts are equal when they are identical after each run of white space has become one space. The first pass sets bits for the
    hashes of all rows; a hash that comes twice has bits that two rows fall on. In the second pass rows without such bits are
    alone for certain and go straight through, as the group of one that they are. Only the rest is shuffled, where the digests
    themselves decide, so chance hits of the filter change nothing. A group's size and smallest id come from a partial
    aggregate, and its rows meet them in a join that adaptive execution splits, so a group may hold any share of the rows.

    NULL text counts as empty. A NULL id counts as larger than any id. Rows that tie on the smallest id all stay. An empty
    table gives an empty result. Columns of ``df`` with a name of the four new ones are replaced; all others are kept as they are.
    """
    new = ["text_sha256", "keep_id", "group_size", "kept"]
    own = [c for c in df.columns if c not in new]
    rows = df.select(row_of(df, own), F.sha2(F.regexp_replace(text_of(df, text_col), SPACE, " "), 256).alias("digest"), df[id_col].alias("id"))
    hashed = F.xxhash64("digest")
    built = bits.build(rows.select(hashed.alias("hash")), df.count(), twice=True)
    marked = rows.withColumn("maybe", bits.passes(hashed, built))
    alone = marked.where("not maybe").select(*unpacked(own), F.col("digest").alias("text_sha256"), F.col("id").alias("keep_id"),
                                             F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    maybe = marked.where("maybe")
    # stored, so that both sides of the join are shuffled for it, and a hot group can be split
    groups = stored(maybe.groupBy(F.col("digest").alias("of")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")), "groups")
    met = maybe.join(groups, F.col("digest") == F.col("of")).select(
        *unpacked(own), F.col("digest").alias("text_sha256"), F.col("first").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("first")).alias("kept"))
    return alone.unionByName(met)
