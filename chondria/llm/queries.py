"""Registered queries of the operators, and SQL that checks them where SQL can say what they do."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from chondria.llm import bpe, exact, lexical, mixing, pii, pitman, rules, runs, simhash, suffix, topk, toxicity, warc
from chondria.llm.common import SPACE, SPACE_CHARS, importable


#: Whoever runs this on real data takes a key of their own from a secret store.
PII_KEY = "public example key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                       (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman.scored(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return rows.select("doc_id", "n_entities", "text", F.sha2("text", 256).alias("text_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in texts whose ``crc32(doc_id)`` ends in 0, the words from some place on repeat those that start there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACE_CHARS))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"),
                       F.when((h % 10 == 0) & (F.length(trimmed) > 0), F.split(trimmed, SPACE)).alias("w"))
    rows = rows.select("doc_id", "text", "w", "g", F.size("w").alias("n"))
    rows = rows.withColumn("a", F.expr("if(n > 0, cast(g % n as int), null)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.expr("cast(ceil((n - a) / p) as int)")))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), F.col("n") - F.col("a")))
    return rows.select("doc_id", F.when(F.col("w").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("a"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.a")).alias("start"), F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"), F.expr("1000 * best.n div -best.q").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_suffix_dedup, op3_bpe, op4_exact_dedup, op5_quality, op6_warc, op7_pitman_yor,
                                 op8_mixing, op9_toxicity, op10_pii, op11_periodic_runs,
                                 op12_topk, op13_lexical)}

ORACLE = {
    "op4_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""",
    "op6_warc": r"""
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        g AS (SELECT d, n, max(page_id) AS answer FROM p WHERE n >= 1000 GROUP BY d, n)
        SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
               CASE WHEN page_id <> answer THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> answer THEN answer END AS refers_to FROM p LEFT JOIN g USING (d, n)""",
    "op8_mixing": r"""
        WITH t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          md5('mix:' || doc_id) AS k FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size,
                     [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM t GROUP BY source),
        r AS (SELECT *, row_number() OVER o AS place,
                     (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                     / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS per_w
              FROM s WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST)),
        g AS (SELECT source, source_size, coalesce(least((3 * source_size)::DOUBLE,
                     (SELECT arg_min(per_w, place) FROM r WHERE 3 * source_size > per_w * w) * w), (3 * source_size)::DOUBLE) AS target FROM r),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g),
        p AS (SELECT t.doc_id, t.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
                     sum(t.size) OVER (PARTITION BY t.source ORDER BY t.k, t.doc_id, t.size ROWS UNBOUNDED PRECEDING) AS until
              FROM t JOIN e ON t.source IS NOT DISTINCT FROM e.source)
        SELECT doc_id, size, source_size, target,
               (size * (epochs + CASE WHEN until - size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM p""",
    "op12_topk": r"""
        WITH v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT q.r, q.vec_id AS query_id, c.vec_id,
                     coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
              FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank, vec_id, score
        FROM p QUALIFY rank <= 20""",
    "op13_lexical": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
        o AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d),
        f AS (SELECT r, doc_id, t, count(*) AS tf FROM o GROUP BY ALL),
        z AS (SELECT r, sum(tf)::BIGINT AS n FROM f GROUP BY r),
        g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM z),
        w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, g GROUP BY t, docs),
        b AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
        q AS (SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM b),
        s AS (SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // l))))::BIGINT AS score
              FROM q JOIN f USING (t) JOIN w USING (t) JOIN z USING (r), g GROUP BY ALL HAVING score > 0)
        SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
        FROM s QUALIFY rank <= 20""",
}
