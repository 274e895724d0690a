import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chondria.operators import reads as R, templates as T
from chondria.operators.components import components

READ = "qname string, library string, contig string, five_prime int, strand int, mate_five_prime int, mate_strand int, sum_qual int, is_primary boolean"


def pair(name, a, b, scores, library="l", contig="m", strands=(0, 1)):
    """Both reads of a pair, in the order given."""
    return [(name, library, contig, p, s, q, r, n, True) for p, s, q, r, n in
            ((a, strands[0], b, strands[1], scores[0]), (b, strands[1], a, strands[0], scores[1]))]


def verdicts(spark, rows):
    found = T.mark_duplicates(spark.createDataFrame(rows, READ)).collect()
    assert len(found) == len(rows)
    return sorted(((r["qname"], r["is_duplicate"]) for r in found), key=str)


def brute(rows):
    """{(library, name): is_duplicate} by comparing every template with every other."""
    ends, scores = {}, Counter()
    for name, library, contig, at, strand, mate, mate_strand, n, primary in rows:
        if name is not None and at is not None and primary:
            ends.setdefault((library, name), []).append(((contig, at, strand), mate is not None and (contig, mate, mate_strand)))
            scores[library, name] += n or 0
    found = {}
    for key, own in ends.items():
        places = [e for e, _ in own] if len(own) > 1 else [own[0][0]] + ([own[0][1]] if own[0][1] else [])
        places.sort(key=str)
        found[key] = places
    def worse(key, other):
        return (-scores[other], other[1]) < (-scores[key], key[1])
    out = {}
    for key, places in found.items():
        rivals = [o for o in found if o != key and o[0] == key[0]]
        if len(places) > 1:
            out[key] = any(found[o] == places and worse(key, o) for o in rivals)
        else:
            out[key] = any((len(found[o]) > 1 and places[0] in found[o]) or (found[o] == places and worse(key, o)) for o in rivals)
    return out


def test_mates_share_the_verdict(spark):
    # The scores of single reads would mark one mate of each pair.
    rows = pair("A", 1, 80, (30, 10)) + pair("B", 1, 80, (10, 29)) + pair("C", 80, 1, (5, 5), strands=(1, 0)) + pair("D", 1, 80, (1, 1), strands=(1, 0))
    assert verdicts(spark, rows) == sorted([("A", False), ("B", True), ("C", True), ("D", False)] * 2)


def test_lone_reads_fall_to_pairs(spark):
    lone = [(n, "l", "m", at, 0, None, None, q, True) for n, at, q in (("x", 1, 99), ("y", 5, 3), ("z", 5, 4))]
    unplaced = [("x", "l", None, None, None, None, None, 50, True), ("u", "l", None, None, None, None, None, 50, True), (None, "l", "m", 1, 0, None, None, 9, True)]
    extra = [("z", "l", "m", 70, 0, None, None, 1, False), ("y", "l", "m", 70, 0, None, None, 1, False)]
    got = verdicts(spark, lone + unplaced + extra + pair("A", 1, 80, (1, 1)))
    assert got == sorted([("A", False)] * 2 + [("x", True)] * 2 + [("y", True)] * 2 + [("z", False)] * 2 + [("u", False), (None, False)], key=str)


def test_a_mate_that_is_not_there_counts_by_its_place(spark):
    cut = [pair("A", 1, 80, (9, 9))[0], pair("B", 1, 80, (3, 3))[1]] + pair("C", 80, 1, (2, 2), strands=(1, 0))
    assert verdicts(spark, cut) == [("A", False), ("B", True), ("C", True), ("C", True)]


@pytest.mark.parametrize("seed", range(3))
def test_all_templates_against_all(spark, seed):
    rng, rows = random.Random(seed), []
    for i in range(150):
        library = rng.choice(["l", "k", None])
        a, b = rng.randint(1, 3), rng.randint(4, 6)
        own = pair(f"t{i}", *rng.choice([(a, b), (b, a)]), (rng.randint(0, 3), rng.randint(0, 3)), library, rng.choice("mn"))
        kind = rng.random()
        if kind < 0.3:
            own = [(*own[0][:5], None, None, *own[0][7:])]
        elif kind < 0.4:
            own = own[:1]
        rows += own
    rng.shuffle(rows)
    want = brute(rows)
    got = T.mark_duplicates(spark.createDataFrame(rows, READ)).collect()
    assert [(r["library"], r["qname"], r["is_duplicate"]) for r in got if want[r["library"], r["qname"]] != r["is_duplicate"]] == []
    assert len(got) == len(rows) and 10 < sum(want.values()) < len(want)


# --- optical copies --------------------------------------------------------------------------------------------------

def brute_copies(points, pixels):
    """Points less their groups, by all pairs."""
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, (x, y) in enumerate(points):
        for j in range(i):
            if abs(points[j][0] - x) <= pixels and abs(points[j][1] - y) <= pixels:
                root[find(i)] = find(j)
    return len(points) - len({find(i) for i in range(len(points))})


def test_optical_copies_reads_its_templates_once(spark):
    reads = [r for i in range(6) for r in pair(f"M:1:F:1:1101:{i * 7}:{i}", 10, 90, (5, 5))]
    df = T.optical_copies(T.templates(spark.createDataFrame(reads, READ)))
    assert df.first()["optical"] == 5
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" not in plan



@pytest.mark.parametrize("pixels,spread,n", [(0, 6, 60), (1, 25, 80), (4, 60, 80), (25, 300, 120)])
def test_optical_copies_on_a_small_flow_cell(spark, pixels, spread, n):
    rng = random.Random(pixels)
    places, rows = {}, []
    for i in range(n):
        library, tile, x, y = rng.choice(["l", None]), rng.choice([1, 2]), rng.randint(-spread, spread), rng.randint(0, spread)
        fragment = rng.choice([1, 1, 1, 9])
        name = f"M:7:F:1:{tile}:{x}:{y}#{i}" if i % 3 else f"F:1:{tile}:{x}:{y}/{i}"
        rows += pair(name, fragment, 80, (i, i), library)
        places.setdefault((library, fragment, i % 3 > 0, tile), []).append((x, y))
    rows += pair("no place", 1, 80, (0, 0)) + [("F:1:1:0:0", "l", "m", 1, 0, None, None, 5, True)]
    want = Counter()
    for (library, *_), points in places.items():
        want[library] += brute_copies(points, pixels)
    found = T.templates(spark.createDataFrame(rows, READ))
    got = {r["library"]: r["optical"] for r in T.optical_copies(found, pixels).collect()}
    assert got == dict(want) and sum(got.values()) > 0


def test_names_by_pattern(spark):
    rows = [r for i, x in enumerate((10, 12, 900)) for r in pair(f"run7_t3_x{x}_y5_{i}", 1, 80, (1, 1))]
    found = T.templates(spark.createDataFrame(rows, READ))
    assert [tuple(r)[-4:] for r in T.located(found, r"_t(\d+)_x(\d+)_y(\d+)").orderBy("x").collect()] == [("run7", 3, x, 5) for x in (10, 12, 900)]
    assert T.optical_copies(found, 5, r"_t(\d+)_x(\d+)_y(\d+)").first()["optical"] == 1
    assert T.optical_copies(found).collect() == []


def test_hot_set_shrinks_to_cells(spark):
    """A set of 20,000 copies on one tile is linked over its few cells, not over its points."""
    n = 20_000
    rows = spark.range(n).select(
        F.concat_ws(":", F.lit("M:7:F:1:1"), (F.col("id") * 7919) % 30011, F.col("id") * 104729 % 20011).alias("qname"), F.lit("l").alias("library"),
        F.lit("m").alias("contig"), F.lit(1).alias("five_prime"), F.lit(0).alias("strand"), F.lit(90).alias("mate_five_prime"), F.lit(1).alias("mate_strand"),
        F.col("id").cast("int").alias("sum_qual"))
    found = T.templates(rows)
    assert T.optical_copies(found).first()["optical"] == n - 1
    assert T.mark_duplicates(rows).filter("not is_duplicate").count() == 1
    points = T.located(found).select(F.struct(F.floor(F.col("x") / 2501).alias("gx"), F.floor(F.col("y") / 2501).alias("gy")).alias("cell"), "x", "y")
    cells = points.groupBy("cell").agg(F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).alias("box"))
    assert T._links(cells, points, 2500).count() <= 4 * cells.count() <= 4 * 13 * 9


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- library size ------------------------------------------------------------------------------------------------------

def test_library_size(spark):
    from math import exp
    cases = [(1000, 900), (10, 9), (500_000, 499_990), (100, 2), (5, 5), (0, 0), (3, None)]
    got = spark.createDataFrame(cases, "n long, c long").select("n", "c", T.library_size(F.col("n"), F.col("c")).alias("x")).collect()
    assert [r["x"] is None for r in got] == [False, False, False, False, True, True, True]
    for r in got[:4]:
        assert abs(r["x"] * (1 - exp(-r["n"] / r["x"])) - r["c"]) < max(0.02 * r["c"], 1)


def test_metrics(spark):
    rows = (pair("F:1:1:0:0", 1, 80, (9, 9)) + pair("F:1:1:5:5", 80, 1, (1, 1), strands=(1, 0)) + pair("F:1:2:5:5", 1, 80, (2, 2)) + pair("p", 3, 90, (2, 2))
            + [("x", "l", "m", 1, 0, None, None, 1, True), ("w", "l", "m", 33, 0, None, None, 1, True), ("x", "l", None, None, None, None, None, 1, True),
               ("w", "l", "m", 34, 0, None, None, 1, False), ("q", None, None, None, None, None, None, 1, True)])
    got = {r["library"]: r for r in T.library_metrics(spark.createDataFrame(rows, READ)).collect()}
    r = got["l"]
    assert (r["lone"], r["pairs"], r["unplaced"], r["secondary"], r["lone_duplicates"], r["pair_duplicates"], r["optical_pairs"]) == (2, 4, 1, 1, 1, 2, 1)
    assert r["duplicate_share"] == pytest.approx(5 / 10) and r["library_size"] > 2
    assert tuple(got[None])[1:] == (0, 0, 1, 0, 0, 0, 0, None, None)


# --- coverage by template ------------------------------------------------------------------------------------------------

BASES = "s string, qname string, contig string, start int, end int, mapq int, is_duplicate boolean, paired boolean, quals array<int>, is_primary boolean"


def brute_piles(reads, first, last, cap):
    """{(s, pos): (depth, then bases left out by reason)}"""
    out = {(r[0], p): [set(), 0, 0, 0, 0, 0] for r in reads if r[3] is not None and r[9] is not False for p in range(first, last + 1)}
    for i, (s, name, _, start, end, mapq, dup, paired, quals, primary) in enumerate(reads):
        if start is None or primary is False:
            continue
        for p in range(max(start, first), min(end, last) + 1):
            cell, q = out[s, p], quals[p - start] if quals and p - start < len(quals) else None
            why = 1 if (mapq or 0) < 20 else 2 if dup else 3 if not paired else 4 if q is None or q < 20 else 0
            if why:
                cell[why] += 1
            elif (name or i) in cell[0]:
                cell[5] += 1
            else:
                cell[0].add(name or i)
    return {k: (min(len(v[0]), cap), *v[1:], max(0, len(v[0]) - cap)) for k, v in out.items()}


@pytest.mark.parametrize("seed,width", [(0, 7), (1, 64), (2, 4096)])
def test_template_depth_per_base(spark, seed, width):
    rng = random.Random(seed)
    reads = []
    for i in range(150):
        s, name = rng.choice("ab"), rng.choice([None, *(f"t{rng.randrange(60)}" for _ in range(9))])
        start = rng.choice([None] + [rng.randint(1, 90)] * 20)
        end = start and start + rng.randint(-1, 25)
        quals = rng.choice([None, [], [rng.choice([None, 5, 30, 30]) for _ in range(rng.randint(1, 30))]] + [[rng.choice([19, 20, 30]) for _ in range(30)]] * 9)
        reads.append((s, name, "m", start, end, rng.choice([None, 10, 20, 60, 60, 60, 60]), rng.choice([None, False, False, False, True]),
                      rng.choice([True, True, True, True, False]), quals, rng.choice([None, True, True, True, False])))
    df = spark.createDataFrame(reads, BASES)
    targets = spark.createDataFrame([("m", 5, 40), ("m", 41, 95), ("other", 1, 3)], "contig string, start int, end int")
    got = {(r["s"], r["pos"]): tuple(r)[3:] for r in R.template_depth(df, targets, cap=2, width=width).collect()}
    want = brute_piles(reads, 5, 95, 2)
    assert got == want
    for r in R.coverage_shares(R.template_depth(df, targets, cap=2, width=width)).collect():
        mine = [v for (s, _), v in want.items() if s == r["s"]]
        total = sum(map(sum, mine))
        assert r["territory"] == 91 and r["mean_coverage"] == pytest.approx(sum(v[0] for v in mine) / 91)
        assert r["share_1x"] == pytest.approx(sum(v[0] >= 1 for v in mine) / 91)
        assert [r[f"exc_{n}"] for n in R.EXCLUDED] == pytest.approx([sum(v[i + 1] for v in mine) / total for i in range(6)])
        assert r["exc_total"] == pytest.approx(sum(map(sum, (v[1:] for v in mine))) / total)


def test_a_name_of_many_reads(spark):
    """A third of the reads share one name: their blocks unite over the positions of a tile, however many reads there are."""
    rows = spark.range(3000).select(
        F.lit("a").alias("s"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("qname"), F.lit("m").alias("contig"),
        (F.col("id") % 97 + 1).cast("int").alias("start"), (F.col("id") % 97 + 10).cast("int").alias("end"), F.lit(60).alias("mapq"), F.lit(False).alias("is_duplicate"),
        F.lit(True).alias("paired"), F.array_repeat(F.lit(30), 10).alias("quals"))
    targets = spark.createDataFrame([("m", 1, 106)], "contig string, start int, end int")
    got = R.coverage_shares(R.template_depth(rows, targets)).first()
    assert got["mean_coverage"] == pytest.approx((2000 * 10 + 106) / 106) and got["exc_overlap"] == pytest.approx((1000 * 10 - 106) / 30000)
