"""Quality rules: robust multivariate outliers by minimum covariance determinant. DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chondria.functions.casts import bound
from chondria.llm.common import SPACE, SPACE_CHARS, stored, text_of

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

GRID = 64               # features are whole numbers of 1/GRID, so that sums are exact in any order
HALF = 0.75             # share of a group's rows that an estimate rests on
STEPS = 3               # concentration steps
MIN_ROWS = 200          # smaller groups of language and source are estimated together, by language, then all
LEAST_ROWS = 30         # fewer rows than this that are left over are judged by the estimate over all rows; if those are fewer, too, there is no verdict by distance
LEFT = "all"            # pool of what is left over
CUT = 33.0              # squared distance from which a row is rejected: about the 1 - 1e-5 quantile of chi-square with 6 degrees, if no floor were added
MEDIAN = 5.348          # median of chi-square with 6 degrees
BINS = 16               # distance bins per doubling
#: Feature, and the least standard deviation that an estimate may give it.
FEATURES = {"f_words": 1.0, "f_length": 0.25, "f_symbols": 0.35, "f_lines": 0.35, "f_repeats": 0.35, "f_capitals": 0.35}


def repeated_words(words: Column) -> Column:
    """Number of words of an array that lie in a window of ``WINDOW`` words found twice or more.

    Windows are told apart by 64-bit hashes. Only a text with an equal pair goes on: its windows are sorted by hash, those with an equal
    neighbour by place, and each covers the words up to the next start.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                         lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = bound(placed, lambda p: F.transform(
            F.filter(p, lambda x, j: F.coalesce(x["h"] == F.get(p, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(p, j + 1)["h"], F.lit(False))),
            lambda x: x["i"]))
        return bound(F.array_sort(twice), lambda s: F.aggregate(
            F.transform(s, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

    return F.when(F.size(words) > WINDOW, bound(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))).otherwise(0)


def statistics(df: DataFrame, text_col: str, own: list[str]) -> DataFrame:
    """``own`` columns and the counts of every whole text."""
    kept = [F.col(c) for c in own]
    text, trimmed = F.col("_q_text"), F.btrim(F.col("_q_text"), F.lit(SPACE_CHARS))
    rows = df.select(*kept, text_of(df, text_col).alias("_q_text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    rows = rows.select(*kept, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)).alias("_q_words"),
                       lines.alias("_q_lines"), F.length(text).alias("_q_length"),
                       *[F.length(F.translate(text, chars, "")).alias(name)
                         for name, chars in (("_q_dense", SPACE_CHARS), ("_q_plain", SYMBOLS), ("_q_small", CAPITALS))])
    return rows.select(*kept, F.size("_q_words").cast("long").alias("n_words"), F.col("_q_dense").cast("long").alias("word_chars"),
                       (F.col("_q_length") - F.col("_q_plain")).cast("long").alias("n_symbols"),
                       (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"),
                       repeated_words(F.col("_q_words")).cast("long").alias("n_repeat_words"),
                       F.size("_q_lines").cast("long").alias("n_lines"), (F.col("_q_length") - F.col("_q_small")).cast("long").alias("n_capitals"))


def features() -> dict[str, Column]:
    """Statistics made comparable: logarithms of counts and of shares, on a grid."""
    def share(part: str, whole: str, times: int) -> Column:
        return F.log1p(times * F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    logs = {"f_words": F.log1p("n_words"), "f_length": F.log1p(F.col("word_chars") / F.greatest("n_words", F.lit(1))),
            "f_symbols": share("n_symbols", "word_chars", 100), "f_lines": share("n_dup_lines", "n_lines", 10),
            "f_repeats": share("n_repeat_words", "n_words", 10), "f_capitals": share("n_capitals", "word_chars", 10)}
    return {name: F.round(x * GRID).cast("long") for name, x in logs.items()}


def pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def cholesky(sums: DataFrame) -> DataFrame:
    """(pool, n, m0.., l00..): centre and Cholesky factor of each pool's covariance, floored on the diagonal by ``FEATURES``."""
    floors = [(s * GRID) ** 2 for s in FEATURES.values()]
    rows = sums.select("pool", "n", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(len(floors))],
                       *[F.col(f"s{i}{j}").alias(f"s{i}{j}") for i, j in pairs()])
    rows = rows.select("*", *[(F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}") + (floors[i] if i == j else 0.0)).alias(f"c{i}{j}")
                              for i, j in pairs()])
    for j in range(len(floors)):
        past = [F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)]
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - sum(past, F.lit(0.0)), F.lit(floors[j] * 0.01))))
        rows = rows.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}")
                                 for i in range(j + 1, len(floors))})
    return rows.select(F.col("pool").alias("_pool"), F.col("n").alias("_n"), *[f"m{i}" for i in range(len(floors))], *[f"l{i}{j}" for i, j in pairs()])


def with_distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2`` to their pool's centre, by forward substitution."""
    met = rows.join(estimate, F.col("pool") == F.col("_pool"))
    for i, name in enumerate(FEATURES):
        past = sum((F.col(f"l{i}{k}") * F.col(f"_y{k}") for k in range(i)), F.lit(0.0))
        met = met.withColumn(f"_y{i}", (F.col(name) - F.col(f"m{i}") - past) / F.col(f"l{i}{i}"))
    return met.select(*rows.columns, "_n", sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(len(FEATURES))), F.lit(0.0)).alias("d2"))


def distance_bin() -> Column:
    return F.floor(F.log2(F.greatest(F.col("d2"), F.lit(1e-3))) * BINS).cast("int")


def bin_sums(rows: DataFrame) -> DataFrame:
    """Counts, sums and sums of products by pool and distance bin: a bounded number of bins, summed where the rows are."""
    names = list(FEATURES)
    return rows.groupBy("pool", distance_bin().alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(x).cast("double")).alias(f"s{i}") for i, x in enumerate(names)],
        *[F.sum((F.col(names[i]) * F.col(names[j])).cast("double")).alias(f"s{i}{j}") for i, j in pairs()])


def below(bins: DataFrame, share: float) -> DataFrame:
    """The bins of each pool up to the one in which ``share`` of its rows is reached."""
    running = Window.partitionBy("pool").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return bins.select("*", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("_before"), F.sum("n").over(Window.partitionBy("pool")).alias("_all")
                       ).where(F.col("_before") < share * F.col("_all"))


def starting_point(rows: DataFrame) -> DataFrame:
    """An estimate with each feature's median and quartile range in its pool, and no correlation: where concentration starts."""
    long = rows.select("pool", F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(x).alias("x")) for i, x in enumerate(FEATURES)])).alias("v"))
    counts = long.groupBy("pool", F.col("v.f").alias("f"), F.col("v.x").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("pool", "f")
    ranked = counts.select("*", F.sum("n").over(by.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)).alias("to"), F.sum("n").over(by).alias("all"))
    quartiles = ranked.groupBy("pool", "f").agg(F.max("all").alias("n"), *[
        F.min(F.when(F.col("to") >= q * F.col("all"), F.col("x"))).alias(name) for q, name in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))])
    floors = list(FEATURES.values())
    per = [F.max(F.when(F.col("f") == i, F.struct("q1", "q2", "q3"))).alias(f"q{i}") for i in range(len(floors))]
    wide = quartiles.groupBy("pool").agg(F.max("n").alias("n"), *per)
    deviation = [F.sqrt(F.pow((F.col(f"q{i}.q3") - F.col(f"q{i}.q1")) / 1.349, 2) + (s * GRID) ** 2) for i, s in enumerate(floors)]
    return wide.select(F.col("pool").alias("_pool"), F.col("n").alias("_n"), *[F.col(f"q{i}.q2").cast("double").alias(f"m{i}") for i in range(len(floors))],
                       *[(deviation[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in pairs()])


def judged(df: DataFrame, carry: list[str] | None = None, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``carry`` columns (all of ``df`` by default) of every row, its statistics, ``base_failed``, ``distance`` and ``kept``.

    Base rules: fewer than 10 words, or over 20 % of the words in repeated 5-word windows. The method's verdict: in each pool, a
    minimum-covariance-determinant estimate of the transformed statistics' centre and covariance, made from the rows that pass the base rules.
    It starts at medians and quartile ranges; each concentration step keeps the 75 % of rows nearest to the last estimate and makes the
    next one from them. The floors of ``FEATURES`` are added to the variances, and distances whose median is above ``MEDIAN`` are put to scale by it, never
    those below: so the cut is looser than a quantile. A row farther than ``CUT`` is rejected.
    A pool is a language and source; those with fewer than ``MIN_ROWS`` rows are pooled by language, then altogether; where that still makes fewer than
    ``LEAST_ROWS``, they are judged by the estimate over all rows, if there are as many of those. Each step is one partial aggregate over all rows into distance bins, so a pool may hold any share
    of the rows, and its result doesn't depend on how they are dealt out. Estimates are one row a pool.

    NULL text counts as empty and fails the base rules. NULL language or source is a value of its own. Repeated rows count as often as
    they come. Columns of ``df`` named like a new one are replaced. An empty table gives an empty result.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"]
    own = [c for c in (df.columns if carry is None else carry) if c not in new]
    inner = {c: f"_own_{i}" for i, c in enumerate(own)}
    source = df.select(*[df[c].alias(a) for c, a in inner.items()], df[lang_col].alias("_q_lang"), df[source_col].alias("_q_source"), df[text_col].alias("_q_in"))
    rows = stored(statistics(source, "_q_in", [*inner.values(), "_q_lang", "_q_source"]), "statistics")
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    small = rows.where("not base_failed").groupBy("_q_lang", "_q_source").agg(F.count(F.lit(1)).alias("n"))
    lang_n = F.sum(F.when(F.col("n") < MIN_ROWS, F.col("n")).otherwise(0)).over(Window.partitionBy("_q_lang"))
    pools = stored(small.select(F.col("_q_lang").alias("_lang"), F.col("_q_source").alias("_source"), F.when(F.col("n") >= MIN_ROWS, F.to_json(F.struct("_q_lang", "_q_source")))
                                .when(lang_n >= MIN_ROWS, F.to_json(F.struct("_q_lang"))).otherwise(LEFT).alias("pool"), "n"), "pools")
    left = pools.where(F.col("pool") == LEFT).agg(F.sum("n")).first()[0]
    pools = pools.drop("n")
    facts = rows.where("not base_failed").join(pools, F.col("_q_lang").eqNullSafe(F.col("_lang")) & F.col("_q_source").eqNullSafe(F.col("_source")))
    facts = stored(facts.select("pool", *[x.alias(n) for n, x in features().items()]), "features")
    if left and left < LEAST_ROWS:
        facts = facts.withColumn("pool", F.explode(F.array_distinct(F.array("pool", F.lit(LEFT)))))
    estimate = stored(starting_point(facts), "estimate")
    for _ in range(STEPS):
        near = below(bin_sums(with_distance(facts, estimate)), HALF).groupBy("pool").agg(
            *[F.sum(c).alias(c) for c in ["n", *[f"s{i}" for i in range(len(FEATURES))], *[f"s{i}{j}" for i, j in pairs()]]])
        estimate = stored(cholesky(near), "estimate")
    bins = with_distance(facts, estimate).groupBy("pool", distance_bin().alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    scale = below(bins, 0.5).groupBy(F.col("pool").alias("of")).agg(F.max("_all").alias("_rows"), F.pow(F.lit(2.0), (F.max("bin") + 0.5) / BINS).alias("middle"))
    estimate = stored(estimate.join(scale, F.col("_pool") == F.col("of")).drop("of"), "estimate")
    final = pools.join(estimate, F.col("pool") == F.col("_pool")).drop("pool")
    final = final.select(*[c for c in final.columns if c != "_pool"], F.col("_pool").alias("_key"))
    stats = [c for c in new if c not in ("distance", "kept", "base_failed")]
    given = rows.select(*inner.values(), "_q_lang", "_q_source", *stats, "base_failed", *[x.alias(n) for n, x in features().items()])
    met = given.join(stored(final, "estimates"), F.col("_q_lang").eqNullSafe(F.col("_lang")) & F.col("_q_source").eqNullSafe(F.col("_source")), "left")
    for i, name in enumerate(FEATURES):
        past = sum((F.col(f"l{i}{k}") * F.col(f"_y{k}") for k in range(i)), F.lit(0.0))
        met = met.withColumn(f"_y{i}", (F.col(name) - F.col(f"m{i}") - past) / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(len(FEATURES))), F.lit(0.0)) / F.greatest(F.col("middle") / MEDIAN, F.lit(1.0))
    met = met.withColumn("distance", F.when(F.col("_rows") >= LEAST_ROWS, d2))
    return met.select(*[F.col(a).alias(c) for c, a in inner.items()], *stats, "base_failed", "distance",
                      (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= CUT)).alias("kept"))
