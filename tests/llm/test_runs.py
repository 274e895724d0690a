import random

import numpy as np
import pytest

import plain
from chondria.llm import runs
from chondria.llm.queries import QUERIES
from samples import ODD

SF = "/root/testdata/sf0.001"


def drawn(rng, n):
    """Words with some stretches that repeat."""
    w = [f"w{rng.randrange(rng.choice([1, 2, 5, 20, 1000]))}" for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 3 else 0):
        a = rng.randrange(n)
        p = rng.randint(1, max(1, min(n - a, n // 3)))
        for i in range(a, a + rng.randint(0, n - a)):
            w[i] = w[a + (i - a) % p]
    return w


def found(texts, least=12):
    return [([tuple(r.values()) for r in own], kept) for _, own, kept in runs._rows([" ".join(w).encode() for w in texts], least)]


@pytest.mark.parametrize("least", [2, 12, 20])
def test_runs_are_those_of_every_period(least):
    rng = random.Random(least)
    for _ in range(60):
        texts = [drawn(rng, rng.choice([0, 1, 5, 12, 13, 30, 60, 150])) for _ in range(rng.randint(1, 12))]
        want = [plain.runs(w, least) for w in texts]
        assert found(texts, least) == [(r, plain.without_runs(w, r)) for w, r in zip(texts, want)]


def test_splitting_goes_on_until_no_word_stands_alone():
    # Each split makes one more word stand alone: w1 u1 w0 w2 u2 w1 ...
    chain = [x for i in range(1, 3000) for x in (i, 10_000 + i, i - 1)]
    lo, hi = runs.survivors(np.array(chain), np.array([0]), np.array([len(chain)]), 12)
    assert not len(lo)
    rng = random.Random(3)
    for _ in range(50):
        w = [rng.randrange(40) for _ in range(rng.randint(0, 200))]
        pieces, done = [(0, len(w))], []
        while pieces:
            a, b = pieces.pop()
            alone = [i for i in range(a, b) if w[a:b].count(w[i]) == 1]
            if b - a < 12 or not alone:
                done += [(a, b)] * (b - a >= 12)
            else:
                pieces += zip([a, *(i + 1 for i in alone)], [*alone, b])
        lo, hi = runs.survivors(np.array(w, np.int64), np.array([0]), np.array([len(w)]), 12)
        assert list(zip(lo.tolist(), hi.tolist())) == sorted(done)


def test_long_texts():
    """Texts in which every lag, or very many, match somewhere."""
    assert found([["a"] * 300_000]) == [([(0, 300_000, 1)], "a")]
    (own, _), = found([(["a"] * 300 + ["b"]) * 400])
    assert (0, 301 * 400, 301) in own and len(own) == 401
    word = ["a"], ["a", "b"]
    while len(word[1]) < 1500:
        word = word[1], word[1] + word[0]
    assert found([word[1]])[0][0] == plain.runs(word[1])


def test_odd_rows(docs):
    got = runs.periodic_runs(docs(ODD, extra=True)).collect()
    want = []
    for i, w in ((r[0], plain.words(r[1])) for r in ODD):
        own = plain.runs(w) if len(w) < 1000 else [(0, len(w), 2 * 9973)]      # the long text takes squares modulo 9,973
        want.append((i, len(w), own, plain.without_runs(w, own)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr) == sorted(want, key=repr)
    assert runs.periodic_runs(docs([])).collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        w = plain.planted(i, plain.words(text))
        if len(w) > 3000:       # the brute force is quadratic
            continue
        all_ = plain.runs(w)
        best = min(all_, key=lambda r: (-r[1], r[0], r[2])) if all_ else (None,) * 3
        sha = [plain.hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{a},{n},{q}\n" for a, n, q in all_), plain.without_runs(w, all_))]
        assert got[i] == (len(all_), *best, 1000 * best[1] // best[2] if all_ else None, *sha)
