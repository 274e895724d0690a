import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chondria.llm import lexical
from plain import LOWER
from samples import ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=20):
    """[(item, rank, doc, score)], every document scored for every item."""
    def terms(text):
        return TERM.findall((text or "").translate(LOWER))

    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, all_ = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 25 + 25 * sum(c.values()) * n // all_
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            scores += [(-s, i is None, i)] * (s > 0)
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, rows, items, k=20, extra=False):
    asked = spark.createDataFrame(items, "item_id long, text string")
    asked = asked.select("*", F.lit("x").alias("item"), F.lit("y").alias("term"))
    return sorted((tuple(r) for r in lexical.ranked(docs(rows, extra), asked, k).collect()), key=repr)


@pytest.mark.parametrize("k", [1, 3, 20])
def test_ranks_are_those_of_all_scores(spark, docs, monkeypatch, k):
    monkeypatch.setattr(lexical, "DOCS", 37)        # several shards, and blocks of items
    monkeypatch.setattr(lexical, "ITEMS", 4)
    rng = random.Random(k)
    words = [f"{c}{i}" for i in range(60) for c in ("w", "W", "é")]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(words[:rng.choice([5, 40, 180])]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60))) for i in range(400)]
    items = [(i, text(rng.randint(0, 25))) for i in range(12)]
    assert found(spark, docs, rows, items, k) == brute(rows, items, k)


def test_ties_and_repeats(spark, docs):
    rows = [(i % 70, "same words here") for i in range(100)] + [(None, "same words here")] + [(200 + i, f"rare{i}") for i in range(200)]
    items = [(1, "Same words"), (1, "Same words"), (None, "words words HERE")]
    assert found(spark, docs, rows, items) == brute(rows, items)


def test_odd_rows(spark, docs):
    items = [(0, None), (1, ""), (2, "--"), (3, "quiet RIVER one"), (4, "nowhere"), (5, "word25 and word36 \x85é"), (5, "a\x00b")]
    assert found(spark, docs, ODD, items, extra=True) == brute([r[:2] for r in ODD], items)
    assert found(spark, docs, [], items) == []
    assert found(spark, docs, [(1, None), (2, "?")], items) == []
    assert found(spark, docs, ODD, []) == []


def test_accumulators_stop(monkeypatch):
    """Common terms make no accumulators once the rare ones have filled the ranks, and scores stay whole."""
    n, looked = 1000, []
    rare = [(900, np.arange(30 + 5 * i), np.full(30 + 5 * i, 900)) for i in range(3)]
    common = [(10, np.arange(n), np.full(n, 10)) for _ in range(5)]
    whole = lexical.np.partition
    monkeypatch.setattr(lexical.np, "partition", lambda *a: looked.append(1) or whole(*a))
    scores = lexical.best_of(rare + common, n, 20)
    assert (scores[:30] == 2750).all() and (scores[40:] == 0).all() and len(looked) == 1
    # A document that would only tie is still made.
    tie = lexical.best_of([(50, np.arange(20), np.full(20, 50)), (50, np.arange(n), np.full(n, 50))], n, 20)
    assert (tie[20:] == 50).all()
