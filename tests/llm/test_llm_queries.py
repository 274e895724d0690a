from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import DOCS, ODD, PROSE

import corpus_pipeline
import plain
from chondria.llm import rules, simhash
from chondria.llm.queries import ORACLE, QUERIES
from oracle_check import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(SF).exists():
        pytest.skip("no driver tables")
    return connect(SF)


@pytest.fixture(scope="module")
def rows(con):
    return con.execute("select doc_id, text from documents order by 1").fetchall()


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) == []


def test_whole_tables(spark, rows):
    """The rows of each query, by brute force where SQL can't say them."""
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, SF).collect()}
    assert got == plain.classes(rows)
    want = plain.without_repeats([t.encode() for _, t in rows], 400)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op2_suffix_dedup"](spark, SF).collect()}
    assert got == {i: (*w[:3], plain.hashlib.sha256(w[3]).hexdigest()) for (i, _), w in zip(rows, want)}
    got = {r.doc_id: tuple(r)[1:7] for r in QUERIES["op5_quality"](spark, SF).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
    assert got == {i: plain.quality_base(t) for i, t in rows}
    found = {r.doc_id: r for r in QUERIES["op7_pitman_yor"](spark, SF).collect()}
    for i, (held, n, known, total, base) in plain.base_scores(rows).items():
        assert (found[i].held_out, found[i].n_tokens, found[i].n_known, found[i].train_tokens) == (held, n, known, total)
        assert found[i].base_score == pytest.approx(base)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)     # a lower perplexity on texts that it hasn't seen
    for name, extra in (("op3_bpe", {"n_tokens"}), ("op9_toxicity", {"predicted"}), ("op10_pii", {"text"})):
        df = QUERIES[name](spark, SF)
        assert df.count() == len(rows) and extra <= set(df.columns)


def _kept(spark, docs, sf_dir):
    """The pipeline in plain Python, but for the verdicts of the robust estimate."""
    kept = {r.doc_id for r in rules.judged(docs).where("kept").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in kept]
    exact = plain.exact([r[:2] for r in rows])
    rows = [r for r in rows if exact[r[0]][2]]
    near = plain.classes([r[:2] for r in rows])
    return [r for r in rows if near[r[0]][1] == r[0]]


def test_pipeline(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = _kept(spark, docs, SF)
    sizes = plain.Counter()
    for _, text, source in rows:
        sizes[source] += len(plain.words(text))
    want = plain.targets(sizes)
    got = corpus_pipeline.run(spark, SF).collect()
    words, source, longest = {i: len(plain.words(t)) for i, t, _ in rows}, {i: s for i, _, s in rows}, plain.Counter()
    assert {r.doc_id for r in got} <= set(words)
    taken = plain.Counter()
    for r in got:
        taken[source[r.doc_id]] += words[r.doc_id]
    for i, n in words.items():
        longest[source[i]] = max(longest[source[i]], n)
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6 for s in sizes)
    assert max(plain.Counter(r.doc_id for r in got).values()) <= 3
    digest = {i: plain.hashlib.sha256(t.encode()).hexdigest() for i, t, _ in rows}
    assert all(r.decoded_sha256 == digest[r.doc_id] for r in got)


def test_stages_on_odd_tables(spark):
    full = [(r[0], r[1], *(r[2:] or ("en", "a")), 1) for r in ODD]
    for table in (full, []):
        given = spark.createDataFrame(table, DOCS)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, given, SF)
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == given.columns, name
            assert out.count() <= 3 * len(table)


def test_near_duplicates_go_by_row(spark):
    """Clashing and missing ids: only the rows of a group go, and one of them stays."""
    far = " ".join(f"other{i * i} thing{i}" for i in range(60))
    rows = [(1, PROSE, "en", "a", 1), (1, far, "en", "a", 1), (2, PROSE.replace(" ", "\t"), "en", "a", 1), (2, " ".join(f"unlike{i}" for i in range(50)), "en", "b", 1),
            (None, PROSE, "en", "a", 1), (None, "alone in the end " * 9, "en", "a", 1), (None, "alone in the end " * 9, "en", "a", 1),
            (3, None, "en", "b", 1), (4, "", "en", None, 1), (5, "lonely words stand here", "en", "c", 2), (5, "lonely words stand here", "en", "c", 2),
            (5, "lonely words stand here", "en", "d", 1)]
    for extra in ((), ("key", "row")):
        given = spark.createDataFrame(rows, DOCS)
        for c in extra:
            given = given.withColumn(c, F.lit("x"))
        got = corpus_pipeline.near_dedup(spark, given, SF)
        assert got.columns == given.columns
        kept = sorted((tuple(r)[:5] for r in got.collect()), key=str)
        want = [rows[0], rows[1], rows[3], rows[5], rows[7], rows[9]]
        assert kept == sorted(want, key=str)
