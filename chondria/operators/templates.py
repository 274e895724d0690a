"""Templates: the reads of one name. Duplicate marking of pairs and lone reads, optical copies, library size.

A template has the library and name of its reads and one or two ends. An end is the contig, 5' position and strand of a placed, primary read.
Keys are structs, so that a missing library or strand is a value like any other.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from chondria.operators.components import components
from chondria.operators.storage import settled

END = ["contig", "five_prime", "strand"]
#: Two copies closer than this on both axes of a tile come from one cluster.
PIXELS = 2500


def _template() -> Column:
    return F.struct("library", "qname").alias("template")


def templates(reads: DataFrame) -> DataFrame:
    """``template, library, qname, a, b, score``: one row per template with a placed read.

    ``a`` and ``b`` are the ends in canonical order, whichever mate comes first; ``b`` is NULL for a lone read. A pair has two placed reads, or
    one that says where its mate lies (``mate_five_prime``, ``mate_strand`` and, where given, ``mate_contig``) though the mate's row
    is not there. ``score`` is the sum of ``sum_qual`` over the template's reads. Of more than two placed reads the outermost are the ends. Reads without a
    name are no templates; secondary ones (``is_primary`` false, where that column is given) define no end.
    """
    primary = F.coalesce("is_primary", F.lit(True)) if "is_primary" in reads.columns else F.lit(True)
    contig = F.coalesce("mate_contig", "contig") if "mate_contig" in reads.columns else F.col("contig")
    placed = reads.filter(F.col("five_prime").isNotNull() & F.col("qname").isNotNull() & primary)
    end = F.struct(*END)
    mate = F.when(F.col("mate_five_prime").isNotNull(), F.struct(
        contig.alias("contig"), F.col("mate_five_prime").alias("five_prime"), F.col("mate_strand").alias("strand")))
    found = placed.groupBy(_template()).agg(F.min(end).alias("first"), F.max(end).alias("last"), F.count(F.lit(1)).alias("n"), F.min(mate).alias("mate"),
                                            F.sum(F.coalesce("sum_qual", F.lit(0))).alias("score"))
    lone = (F.col("n") == 1) & F.col("mate").isNull()
    here = F.col("n") > 1
    return found.select(
        "template", "template.library", "template.qname", F.when(here | lone, F.col("first")).otherwise(F.least("first", "mate")).alias("a"),
        F.when(lone, None).when(here, F.col("last")).otherwise(F.greatest("first", "mate")).alias("b"), "score")


def kept_templates(found: DataFrame) -> DataFrame:
    """``template`` of those that stay: the best of each set of pairs with equal ends, and the best lone read of an end at which no pair lies.

    Best is the highest score, then the first name. Sets are aggregated, never sorted or listed.
    """
    own = F.struct((-F.col("score")).alias("q"), "template")
    nobody, nowhere = F.when(F.lit(False), own), F.when(F.lit(False), F.col("b"))
    lies = [F.struct(F.col(end).alias("a"), nowhere.alias("b"), nobody.alias("own"), F.lit(True).alias("pair")) for end in ("a", "b")]
    sets = F.array(F.struct("a", "b", own.alias("own"), F.lit(False).alias("pair")))
    rows = found.select("library", F.inline(F.when(F.col("b").isNull(), sets).otherwise(F.concat(sets, F.array(*lies)))))
    best = rows.groupBy(F.struct("library", "a", "b")).agg(F.min("own").alias("best"), F.max("pair").alias("pair"))
    return best.filter("best is not null and not pair").select("best.template")


def verdicts(found: DataFrame) -> DataFrame:
    """``template, is_duplicate`` of every template."""
    kept = kept_templates(found).withColumn("_kept", F.lit(True))
    return found.select("template").join(kept, "template", "left").select("template", F.col("_kept").isNull().alias("is_duplicate"))


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """``reads`` with ``is_duplicate``, the same for all reads of a template, unplaced mates and secondary reads included.

    Of pairs with equal ends, in whichever order, all but the best are duplicates; pairs are compared by the scores of both reads together. A lone
    read is a duplicate if a pair or a better lone read lies at its end. Reads of templates without a place, and reads without a name, are none.
    """
    by_name = verdicts(templates(reads))
    marked = reads.withColumn("_template", _template()).join(by_name, F.col("_template") == F.col("template"), "left")
    return marked.select(*[F.col(c) for c in reads.columns], F.coalesce("is_duplicate", F.lit(False)).alias("is_duplicate"))


# --- optical copies --------------------------------------------------------------------------------------------------

def located(found: DataFrame, pattern: str | None = None) -> DataFrame:
    """Templates with a place on a flow cell: ``lane, tile, x, y`` from the name.

    Names have 5, 7 or 8 fields between colons, with tile, x and y from the third field of 5 and the fifth of 7 or 8; what comes before is the lane.
    ``pattern`` takes their place: an expression with three groups for tile, x and y, all before the first being the lane. Names that don't fit are left out.
    """
    if pattern is not None:
        parts = [F.regexp_extract("qname", pattern, i) for i in (1, 2, 3)]
        lane = F.regexp_extract("qname", f"^(.*?){pattern}", 1)
    else:
        fields = F.split("qname", ":")
        first = F.when(F.size(fields) == 5, 2).when(F.size(fields).isin(7, 8), 4)
        parts = [F.get(fields, first + i) for i in range(3)]
        lane = F.array_join(F.slice(fields, F.lit(1), F.coalesce(first, F.lit(0))), ":")
    number = [F.regexp_extract(p, r"^(-?\d+)", 1).try_cast("long") for p in parts]
    return (found.select("*", lane.alias("lane"), *[n.alias(c) for n, c in zip(number, ("tile", "x", "y"))])
            .filter("tile is not null and x is not null and y is not null"))


def _links(cells: DataFrame, points: DataFrame, pixels: int) -> DataFrame:
    """``a, b``: neighbouring cells with a point in each that are no more than ``pixels`` apart on both axes."""
    steps = F.array(*[F.struct(F.lit(x).cast("long").alias("dx"), F.lit(y).cast("long").alias("dy")) for x, y in ((1, 0), (0, 1), (1, 1), (-1, 1))])
    asks = (cells.select("cell", "box", F.explode(steps).alias("step"))
            .select(F.col("cell").alias("a"), F.col("box").alias("a_box"), "step",
                    F.col("cell").withField("gx", F.col("cell.gx") + F.col("step.dx")).withField("gy", F.col("cell.gy") + F.col("step.dy")).alias("b")))
    near = asks.join(cells.select(F.col("cell").alias("b"), F.col("box").alias("b_box")), "b")
    across = F.when(F.col("step.dx") >= 0, F.col("b_box.x0") - F.col("a_box.x1")).otherwise(F.col("a_box.x0") - F.col("b_box.x1"))
    above = F.col("b_box.y0") - F.col("a_box.y1")
    near = near.filter((F.when(F.col("step.dx") != 0, across).otherwise(0) <= pixels) & (F.when(F.col("step.dy") != 0, above).otherwise(0) <= pixels))
    side, corner = near.filter("step.dx = 0 or step.dy = 0"), near.filter("step.dx <> 0 and step.dy <> 0")
    # Over a corner boxes are not enough. A cell has one highest and one lowest point per column, so a pair of cells has at most 4 * (pixels + 1) rows here.
    edge = points.groupBy("cell", "x").agg(F.min("y").alias("low"), F.max("y").alias("high"))
    pair = corner.select(F.struct("a", "b").alias("pair"), "a", "b", F.col("step.dx").alias("dx"))
    lower = (pair.join(edge.withColumnRenamed("cell", "a"), "a")
             .select("pair", (F.col("x") * F.col("dx") + pixels).alias("at"), F.lit(1).alias("kind"), F.col("high").alias("y")))
    upper = (pair.join(edge.withColumnRenamed("cell", "b"), "b")
             .select("pair", (F.col("x") * F.col("dx")).alias("at"), F.lit(0).alias("kind"), F.col("low").alias("y")))
    so_far = Window.partitionBy("pair").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    reached = (lower.unionByName(upper).withColumn("least", F.min(F.when(F.col("kind") == 0, F.col("y"))).over(so_far))
               .filter((F.col("kind") == 1) & (F.col("least") - F.col("y") <= pixels)))
    return side.select("a", "b").unionByName(reached.select("pair.a", "pair.b").distinct())


def optical_copies(found: DataFrame, pixels: int = PIXELS, pattern: str | None = None) -> DataFrame:
    """``library, optical``: how many pairs are optical copies of another of their duplicate set.

    Copies of one set, lane and tile that are at most ``pixels`` apart on both axes are linked; of each group that links join, all but one are optical. Points are dealt to
    square cells so small that all points of a cell are linked, so a set of any size shrinks to its cells; only cells that have a neighbour within
    reach go on to the components. Lone reads are not looked at.
    """
    if pixels < 0:
        raise ValueError("pixels must not be negative")
    width = pixels + 1
    points = (located(found.filter("b is not null"), pattern).select(
        F.struct("library", "a", "b", "lane", "tile", F.floor(F.col("x") / width).alias("gx"), F.floor(F.col("y") / width).alias("gy")).alias("cell"), "x", "y"))
    # Stored, as both are used several times; templates would be found again for each.
    points = settled(points, "points")
    cells = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).alias("box"))
    cells = settled(cells, "cells")
    joined = components(_links(cells, points, pixels))
    # A group of c cells and n points has n - 1 copies: n - 1 for each of its cells alone, and c - 1 more for what joins them.
    alone = cells.groupBy("cell.library").agg(F.sum(F.col("n") - 1).alias("optical"))
    more = joined.filter("node <> root").groupBy("node.library").agg(F.count(F.lit(1)).alias("optical"))
    return alone.unionByName(more).groupBy("library").agg(F.sum("optical").alias("optical"))


# --- library metrics -------------------------------------------------------------------------------------------------

def library_size(pairs: Column, unique: Column) -> Column:
    """Estimated number of distinct molecules ``x`` with ``unique = x * (1 - exp(-pairs / x))``; NULL where no pair is a copy.

    The root is bracketed between ``unique`` and the first power of ten times it beyond the root, then halved 40 times.
    """
    n, c = pairs.cast("double"), unique.cast("double")

    def over(times: Column) -> Column:
        return F.lit(1.0) / times - 1 + F.exp(-n / (times * c)) > 0

    top = F.aggregate(F.sequence(F.lit(1), F.lit(17)), F.lit(100.0), lambda m, _: F.when(over(m), m * 10).otherwise(m))
    start = F.struct(F.lit(1.0).alias("lo"), top.alias("hi"))

    def halved(s: Column, _: Column) -> Column:
        middle = (s["lo"] + s["hi"]) / 2
        return F.struct(F.when(over(middle), middle).otherwise(s["lo"]).alias("lo"), F.when(over(middle), s["hi"]).otherwise(middle).alias("hi"))

    size = F.aggregate(F.sequence(F.lit(1), F.lit(40)), start, halved, lambda s: F.round(c * (s["lo"] + s["hi"]) / 2).cast("long"))
    return F.when((c > 0) & (n > c), size)


def library_metrics(reads: DataFrame, pixels: int = PIXELS, pattern: str | None = None) -> DataFrame:
    """Duplicate metrics per library.

    ``lone, pairs``: templates by kind; ``unplaced, secondary``: reads; ``lone_duplicates, pair_duplicates, optical_pairs``: templates;
    ``duplicate_share``: of the reads in them; ``library_size``: see :func:`library_size`, from pairs that are no optical copies.
    """
    found = templates(reads)
    marked = found.join(verdicts(found), "template")
    pair = F.col("b").isNotNull()
    by_kind = marked.groupBy("library").agg(
        F.count_if(~pair).alias("lone"), F.count_if(pair).alias("pairs"), F.count_if(~pair & F.col("is_duplicate")).alias("lone_duplicates"),
        F.count_if(pair & F.col("is_duplicate")).alias("pair_duplicates"))
    primary = F.coalesce("is_primary", F.lit(True)) if "is_primary" in reads.columns else F.lit(True)
    rest = reads.groupBy("library").agg(F.count_if(primary & F.col("five_prime").isNull()).alias("unplaced"), F.count_if(~primary).alias("secondary"))
    key = F.struct("library").alias("_l")
    parts = [df.select(key, *[c for c in df.columns if c != "library"]) for df in (rest, by_kind, optical_copies(found, pixels, pattern))]
    out = parts[0].join(parts[1], "_l", "left").join(parts[2], "_l", "left").withColumnRenamed("optical", "optical_pairs")
    counts = ["lone", "pairs", "unplaced", "secondary", "lone_duplicates", "pair_duplicates", "optical_pairs"]
    out = out.select("_l.library", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
    share = F.try_divide(F.col("lone_duplicates") + 2 * F.col("pair_duplicates"), F.col("lone") + 2 * F.col("pairs"))
    size = library_size(F.col("pairs") - F.col("optical_pairs"), F.col("pairs") - F.col("pair_duplicates"))
    return out.select("*", share.alias("duplicate_share"), size.alias("library_size"))
