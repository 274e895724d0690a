"""Read-level jobs over a table of alignments, one row per read or template."""

from pyspark.sql import Column, DataFrame, functions as F, Window

from chondria.operators.joins import lookup_join, positions, tiles
from chondria.operators.summary import mean, median, rows_over, value_counts

TILE = 4096
ALIGNMENT_COLUMNS = ["contig", "pos", "mapq", "cigar", "mate_contig", "mate_pos", "tlen"]


def on_contig(reads: DataFrame, contig: str) -> DataFrame:
    """Reads on ``contig`` whose mate is there too or unmapped; pairs with both ends unmapped are dropped."""
    mate_here = (F.col("mate_contig") == F.col("contig")) | F.col("mate_unmapped")
    return reads.filter((F.col("contig") == contig) & mate_here
                        & ~(F.col("is_unmapped") & F.col("mate_unmapped")))


def reverted(reads: DataFrame, clear: tuple[str, ...] = ("FT", "CO")) -> DataFrame:
    """Reads without alignment columns and without the tags in ``clear``, in name order."""
    tags = F.map_filter("tags", lambda k, v: ~k.isin(list(clear)))
    return reads.drop(*ALIGNMENT_COLUMNS).withColumn("tags", tags).orderBy("qname")


def merged_runs(*runs: DataFrame) -> DataFrame:
    """All runs in coordinate order: range partitions, each sorted. The read name keeps one locus splittable."""
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    keys = ["contig", "pos", "qname"]
    return out.repartitionByRange(*keys).sortWithinPartitions(*keys)


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    n, dup = F.count(F.lit(1)), F.count_if("is_duplicate")
    return marked.groupBy("library").agg(n.alias("reads"), dup.alias("duplicates"), (dup / n).alias("duplicate_rate"))


def good_quality(reads: DataFrame, mapq: int = 20, baseq: int = 20) -> DataFrame:
    return reads.filter((F.col("mapq") >= mapq) & (F.col("baseq") >= baseq))


def good_bases(reads: DataFrame, mapq: int = 20, baseq: int = 20) -> DataFrame:
    """The runs of good bases of well placed reads, as blocks ``s, contig, start, end`` for :func:`per_base_depth`.

    ``reads`` has ``quals``, one quality per base from ``start`` on; a missing quality is none, and a read without one has no block.
    """
    runs = _with_runs(reads.filter((F.col("mapq") >= mapq) & (F.size("quals") > 0)), baseq)
    # The outer form, as the plain one puts a filter on the array below, and with it a second evaluation of what makes the array.
    return (runs.select("s", "contig", F.col("start").alias("_at"), F.inline_outer("_runs")).filter("a is not null")
            .select("s", "contig", (F.col("_at") + F.col("a")).alias("start"), (F.col("_at") + F.col("b")).alias("end")))


def _with_runs(reads: DataFrame, baseq: int) -> DataFrame:
    """``reads`` with ``_runs``: first and last place (``a, b``) of each run of good ``quals``."""
    good = F.transform("quals", lambda q: F.coalesce(q >= baseq, F.lit(False)))

    def edges(step: int) -> Column:
        """Places of good bases whose neighbour is not good."""
        places = F.sequence(F.lit(0), F.size("_good") - 1)
        return F.filter(places, lambda i: F.get("_good", i) & ~F.coalesce(F.get("_good", i + step), F.lit(False)))
    runs = F.when(F.size("_good") > 0, F.arrays_zip(edges(-1).alias("a"), edges(1).alias("b")))
    return reads.withColumn("_good", good).withColumn("_runs", runs).drop("_good")


def per_base_depth(reads: DataFrame, targets: DataFrame, cap: int | None = None, samples: DataFrame | None = None,
                   width: int = TILE) -> DataFrame:
    """``(s, contig, pos, depth)`` of every target position of every sample, zero depth included.

    ``reads`` has closed blocks ``s, contig, start, end``; ``targets`` has closed intervals
    ``contig, start, end``; ``samples`` has ``s, contig`` and defaults to what the reads show. Depth is the
    running sum of block starts and ends: first over tiles, then over the positions inside each tile, so no
    window grows with the contig or with the number of reads.
    """
    groups = (reads if samples is None else samples).select("s", "contig").distinct()
    out = _running(_steps(reads, "depth"), groups, targets, ["depth"], width)
    return out if cap is None else out.withColumn("depth", F.least("depth", F.lit(cap).cast("long")))


def _steps(blocks: DataFrame, name: str) -> DataFrame:
    """``s, contig, pos, name``: 1 where a closed block starts and -1 behind its end."""
    ends = F.array(F.struct(F.col("start").cast("long").alias("pos"), F.lit(1).alias(name)),
                   F.struct((F.col("end") + 1).cast("long").alias("pos"), F.lit(-1).alias(name)))
    return blocks.filter(F.col("end") >= F.col("start")).select("s", "contig", F.inline(ends))


def _running(steps: DataFrame, groups: DataFrame, targets: DataFrame, names: list[str], width: int) -> DataFrame:
    """``s, contig, pos`` of every target position of every group, with the running sums of the ``names`` of ``steps``."""
    cut = targets.select("contig", "start", "end", F.explode(tiles(F.col("start"), F.col("end"), width)).alias("t"))
    pieces = lookup_join(groups, cut, ["contig"], "inner").select(
        "s", "contig", F.greatest(F.col("start").cast("long"), F.col("t") * width).alias("a"),
        F.least(F.col("end").cast("long"), F.col("t") * width + (width - 1)).alias("b"))
    wanted = positions(pieces, "a", "b", ["s", "contig"], width)
    both = (steps.withColumn("hit", F.lit(False))
            .unionByName(wanted.select("s", "contig", "pos", *[F.lit(0).alias(n) for n in names], F.lit(True).alias("hit")))
            .withColumn("t", F.floor(F.col("pos") / width)))
    at = ["s", "contig", "t"]
    by_pos = both.groupBy(*at, "pos").agg(*[F.sum(n).alias(n) for n in names], F.max("hit").alias("hit"))
    net = by_pos.groupBy(*at).agg(*[F.sum(n).alias(n) for n in names], F.max("hit").alias("any"))
    earlier = Window.partitionBy("s", "contig").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    base = (net.select(*at, "any", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in names])
            .filter("any").drop("any"))
    inside = Window.partitionBy(*at).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.sum(n).over(inside) + F.col(f"_{n}")).alias(n) for n in names]
    return by_pos.join(base, at).select("s", "contig", "pos", "hit", *sums).filter("hit").drop("hit")


#: Why a base of a read is not counted, in the order in which reasons are looked for.
EXCLUDED = ["mapq", "dupe", "unpaired", "baseq", "overlap", "capped"]


def template_depth(reads: DataFrame, targets: DataFrame, mapq: int = 20, baseq: int = 20, cap: int | None = None, count_unpaired: bool = False,
                   samples: DataFrame | None = None, width: int = TILE) -> DataFrame:
    """``s, contig, pos, depth`` of every target position, each template counted once, and what is not counted: ``exc_<reason>``.

    ``reads`` has closed blocks ``s, qname, contig, start, end`` with ``mapq``, ``is_duplicate``, ``paired`` and ``quals``, one quality per base; secondary
    ones (``is_primary`` false, where that column is given) and reads without a place are left out. A whole read is left out for the first of: mapping
    quality below ``mapq``; duplicate; mate not placed, unless ``count_unpaired``. Then a base is left out for a quality that is missing or below ``baseq``, and where
    another read of its template (``s, qname``) has a good base at the position. Depth beyond ``cap`` is counted as capped. A missing mapping quality is
    0; missing marks count as false. A read without a name is a template of its own.

    The blocks of a template are united tile by tile, over the positions where its depth changes, so no window is larger than a tile
    whatever the number of reads of a name. All sums run in one pass over the positions.
    """
    if "is_primary" in reads.columns:
        reads = reads.filter(F.coalesce("is_primary", F.lit(True)))
    no = F.lit(False)
    reason = (F.when(F.coalesce("mapq", F.lit(0)) < mapq, "mapq").when(F.coalesce("is_duplicate", no), "dupe")
              .when(~F.coalesce("paired", no) & F.lit(not count_unpaired), "unpaired").otherwise("whole"))
    blocks = (reads.filter(F.col("start").isNotNull() & (F.col("end") >= F.col("start")))
              .select("s", "qname", "contig", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "mapq",
                      F.slice("quals", F.lit(1), (F.col("end") - F.col("start") + 1).cast("int")).alias("quals"), reason.alias("reason")))
    read = _with_runs(blocks, baseq)
    runs = F.when(F.col("reason") == "whole", F.transform("_runs", lambda r: F.struct(
        (F.col("start") + r["a"]).alias("a"), (F.col("start") + r["b"]).alias("b"))))
    read = read.select("s", "qname", "contig", "start", "end", "reason", runs.alias("runs"))

    def event(pos: Column, kind: Column, step: int) -> Column:
        return F.struct(pos.cast("long").alias("pos"), kind.alias("kind"), F.lit(step).alias("step"))

    def run_events(kind: str) -> Column:
        both = [F.transform("runs", lambda r: event(r["a"], F.lit(kind), 1)), F.transform("runs", lambda r: event(r["b"] + 1, F.lit(kind), -1))]
        return F.coalesce(F.concat(*both), F.array().cast("array<struct<pos: bigint, kind: string, step: int>>"))
    own = F.array(event(F.col("start"), F.col("reason"), 1), event(F.col("end") + 1, F.col("reason"), -1))
    nameless = F.when(F.col("qname").isNull(), run_events("depth")).otherwise(F.array().cast("array<struct<pos: bigint, kind: string, step: int>>"))
    events = read.select("s", "contig", F.inline_outer(F.concat(own, run_events("good"), nameless))).filter("pos is not null")
    cut = (read.filter("qname is not null").select("s", "contig", "qname", F.inline_outer("runs")).filter("a is not null")
           .select("s", "contig", "qname", "a", "b", F.explode(tiles(F.col("a"), F.col("b"), width)).alias("t")))
    ends = F.inline(F.array(F.struct(F.greatest("a", F.col("t") * width).alias("pos"), F.lit(1).alias("step")),
                            F.struct((F.least("b", F.col("t") * width + (width - 1)) + 1).alias("pos"), F.lit(-1).alias("step"))))
    tile = ["s", "contig", "qname", "t"]
    changes = cut.select(*tile, ends).groupBy(*tile, "pos").agg(F.sum("step").alias("step"))
    order = Window.partitionBy(*tile).orderBy("pos")
    now = F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    united = changes.select("s", "contig", "pos", F.lit("depth").alias("kind"), ((now > 0).cast("int") - (before > 0).cast("int")).alias("step"))
    names = ["mapq", "dupe", "unpaired", "whole", "good", "depth"]
    steps = events.unionByName(united.filter("step <> 0")).select(
        "s", "contig", "pos", *[F.when(F.col("kind") == n, F.col("step")).otherwise(0).alias(n) for n in names])
    groups = (blocks if samples is None else samples).select("s", "contig").distinct()
    sums = _running(steps, groups, targets, names, width)
    depth = F.col("depth") if cap is None else F.least("depth", F.lit(cap).cast("long"))
    lost = [F.col("mapq"), F.col("dupe"), F.col("unpaired"), F.col("whole") - F.col("good"), F.col("good") - F.col("depth"), F.col("depth") - depth]
    return sums.select("s", "contig", "pos", depth.alias("depth"), *[c.alias(f"exc_{n}") for n, c in zip(EXCLUDED, lost)])


def coverage_shares(depth: DataFrame, over: tuple[int, ...] = (1, 5, 10, 20, 30)) -> DataFrame:
    """Per sample, from :func:`template_depth`: number of positions, mean and median depth, share of positions covered ``over`` times, and the
    shares of all aligned bases that each reason left out (NULL without any base)."""
    each = [F.sum(f"exc_{n}").alias(f"exc_{n}") for n in EXCLUDED]
    counts = depth.groupBy("s", F.col("depth").alias("v")).agg(F.count(F.lit(1)).alias("n"), *each)
    bases = F.sum(F.col("v") * F.col("n"))
    everything = bases
    for n in EXCLUDED:
        everything = everything + F.sum(f"exc_{n}")
    total = F.sum("n")
    return counts.groupBy("s").agg(
        total.alias("territory"), mean().alias("mean_coverage"), median().alias("median_coverage"),
        *[(rows_over(x - 1) / total).alias(f"share_{x}x") for x in over],
        *[F.try_divide(F.sum(f"exc_{n}"), everything).alias(f"exc_{n}") for n in EXCLUDED],
        F.try_divide(everything - bases, everything).alias("exc_total"))


def coverage_summary(depth: DataFrame) -> DataFrame:
    """Mean, its floor, and median depth per sample."""
    return value_counts(depth, ["s"], F.col("depth")).groupBy("s").agg(
        mean().alias("mean_coverage"), median().alias("median_coverage"), F.floor(mean()).alias("mean_coverage_floor"))
