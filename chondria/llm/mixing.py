"""Mixing sources to target weights, cut by distributed prefix sums."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from chondria.llm.common import row_of, stored, unpacked, word_count

WEIGHTS = (5, 2, 1)
MOST = 3                # times its size that a source may give
BUCKET_ROWS = 1024      # rows that a range of keys is to have


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes(source, source_size)``, one row a source, with ``target``.

    Sources by code point, NULL last, take ``weights`` in turn and share the sum of all sizes by them. A target stops at ``most`` times its
    source's size; the excess goes to the others by weight. In the order of ``most * size / weight``, the sources that stop come
    first, so one running sum tells the share per weight of the rest. The windows run over one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", w.alias("w")).withColumn("most", most * F.col("source_size"))
    rising = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.select("*", ((F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0)))
                             / F.sum("w").over(rest)).alias("per_w"), F.row_number().over(rising).alias("at"))
    share = F.min(F.when(F.col("most") > F.col("per_w") * F.col("w"), F.struct("at", "per_w"))).over(Window.partitionBy())["per_w"]
    return rows.withColumn("share", share).select(
        "source", "source_size", F.coalesce(F.least(F.col("most").cast("double"), F.col("share") * F.col("w")),
                                            F.col("most").cast("double")).alias("target"))


def key_of(id_: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix",
          weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Every row of ``df`` with ``size``, ``source_size``, ``target`` and ``copies``, the number of times that the mix takes it.

    A row's key is a hash of ``seed`` and its id, so each source has a random order that reruns repeat. A source gives as many whole
    epochs as its target holds; of the last one, the rows in key order up to the rest of the budget, a row counting when at least
    half of it fits. The order is dealt out in ranges of keys: range sums give each range its place in the source, and
    only the one range that the budget cuts is sorted. A hot source thus has more ranges, not a larger task. Rows themselves
    aren't shuffled but for that range; they meet one row a source.

    NULL text has size 0; NULL source is a source of its own; rows whose ids tie follow id and size, and equal ones are interchangeable;
    a NULL id has the key of an empty one. Zero-sized sources have target 0. An empty table gives an empty result. Columns of ``df`` named like the
    four new ones are replaced.
    """
    new = ["size", "source_size", "target", "copies"]
    own = [c for c in df.columns if c not in new]
    sized = df.select(row_of(df, own), df[source_col].alias("source"), df[id_col].alias("id"), word_count(df[text_col]).alias("size"),
                      key_of(df[id_col], seed).alias("key"))
    facts = stored(sized.select("source", "size", "key"), "sizes")
    n = facts.count()
    digits = max(1, math.ceil(math.log(max(2, n / BUCKET_ROWS), 16)))
    ranges = stored(facts.groupBy("source", F.substring("key", 1, digits).alias("range")).agg(F.sum("size").alias("words")), "ranges")
    plan = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most).select(
        "*", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ranges.select("source", "range", "words", F.sum("words").over(running).alias("end"))
    p = plan.select(F.col("source").alias("of"), "source_size", "target", "epochs", "rest")
    # of each source, the first range that ends beyond the rest of the budget; none when the rest is the whole source
    cut = (p.join(ends, p.of.eqNullSafe(F.col("source")), "left").groupBy("of", "source_size", "target", "epochs", "rest")
           .agg(F.min(F.when(F.col("end") > F.col("rest"), F.struct("range", (F.col("end") - F.col("words")).alias("start")))).alias("cut")))
    cut = stored(cut.select(F.col("of"), F.col("source_size"), "target", "epochs", "rest", F.col("cut.range").alias("cut"), F.col("cut.start").alias("start")), "cuts")
    met = sized.withColumn("range", F.substring("key", 1, digits)).join(cut, F.col("source").eqNullSafe(F.col("of")))
    at_cut = F.coalesce(F.col("range") == F.col("cut"), F.lit(False))
    ahead = F.coalesce(F.col("range") < F.col("cut"), F.lit(True))
    sorted_ = Window.partitionBy("of").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.col("start") + F.sum("size").over(sorted_) - F.col("size") / 2

    def out(rows: DataFrame, taken: Column) -> DataFrame:
        return rows.select(*unpacked(own), "size", "source_size", "target", (F.col("epochs") + taken.cast("long")).alias("copies"))

    return out(met.where(~at_cut), ahead).unionByName(out(met.where(at_cut), until <= F.col("rest")))
