"""Joins and numbering that stay even when one key holds a large share of the rows."""

from pyspark.sql import Column, DataFrame, functions as F, Window


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``left`` with a lookup table that has few rows per key.

    Nothing is counted or stored while the plan is made. Spark broadcasts the lookup side by its bytes: by the size of
    its files where it is stored, by the size of its shuffled rows where it is computed
    (``spark.sql.autoBroadcastJoinThreshold``). Beyond that the join shuffles both sides once, and adaptive execution
    splits the partition of a hot key among several tasks, each with the few lookup rows of that partition. It does so
    only where both sides come straight from a shuffle; a lookup grouped by the same keys would not. The hash beside
    the keys asks for a shuffle of its own in that case too.
    """
    both = [side.withColumn("_hash", F.xxhash64(*keys)) for side in (left, right)]
    return both[0].join(both[1], [*keys, "_hash"], how).drop("_hash")


def own_lookup(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`lookup_join` of ``left`` with a table that is counted from its own rows; missing keys find nothing.

    Spark would filter the missing keys out of what ``right`` is counted from, but not out of ``left``, so that the same rows would be computed and shuffled
    for each. Missing keys are filled in here and told apart by ``_gaps``, so both sides share them. Of a key only the filled one is shuffled.
    """
    def filled(side: DataFrame) -> DataFrame:
        kinds, rest = dict(side.dtypes), [c for c in side.columns if c not in keys]
        gaps = sum((F.col(k).isNull().cast("int") * 2 ** i for i, k in enumerate(keys)), F.lit(0))
        return side.select(*[F.coalesce(k, F.lit("" if kinds[k] == "string" else 0).cast(kinds[k])).alias(k) for k in keys], gaps.alias("_gaps"),
                           F.xxhash64(*keys).alias("_hash"), *rest)
    found = [c for c in right.columns if c not in keys]
    both = filled(left).join(filled(right), [*keys, "_gaps", "_hash"], "left")
    return both.select(*[F.when(F.col("_gaps").bitwiseAND(2 ** i) == 0, F.col(k)).alias(k) for i, k in enumerate(keys)], *[c for c in left.columns if c not in keys],
                       *[F.when(F.col("_gaps") == 0, F.col(c)).alias(c) for c in found])


def keep_listed(left: DataFrame, ids: DataFrame, key: str, listed: bool = True) -> DataFrame:
    """Rows of ``left`` whose key is (or is not) in ``ids``."""
    return lookup_join(left, ids.select(key), [key], "left_semi" if listed else "left_anti")


def number_within(df: DataFrame, keys: list[str], order: str, name: str, width: int = 65536) -> DataFrame:
    """0-based number of each row within its key, by the unique whole number ``order``.

    Rows are numbered in stretches of ``width`` order values and shifted by the rows of earlier stretches, so
    no window holds more than ``width`` rows of a key, however many rows the key has.
    """
    cut = df.withColumn("_part", F.floor(F.col(order) / F.lit(width)).cast("long"))
    sizes = cut.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(order)) - 1
    return (cut.withColumn("_place", place).join(offsets, [*keys, "_part"])
            .withColumn(name, (F.col("_place") + F.col("_before")).cast("long"))
            .drop("_part", "_place", "_before"))


def prefixes(text: Column) -> Column:
    """All non-empty prefixes of a text, so that a prefix test becomes an equality join."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
                       lambda n: F.substring(text, F.lit(1), n))


def tiles(start: Column, end: Column, width: int) -> Column:
    """Numbers of the ``width``-base tiles that a closed interval touches; empty when ``end < start``."""
    first, last = F.floor(start / width), F.floor(end / width)
    return F.when(end >= start, F.sequence(first.cast("long"), last.cast("long")))


def positions(intervals: DataFrame, start: str, end: str, keep: list[str], width: int = 4096) -> DataFrame:
    """Every position of closed intervals, one row each; long intervals are cut first."""
    by_tile = intervals.select(*keep, F.col(start).alias("_a"), F.col(end).alias("_b"),
                               F.explode(tiles(F.col(start), F.col(end), width)).alias("_t"))
    lo = F.greatest(F.col("_a").cast("long"), F.col("_t") * width)
    hi = F.least(F.col("_b").cast("long"), F.col("_t") * width + (width - 1))
    return by_tile.select(*keep, F.explode(F.sequence(lo, hi)).alias("pos"))
