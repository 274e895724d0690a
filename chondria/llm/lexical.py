"""Ranked lexical search: postings by shard, scored term at a time with a limit on accumulators.

The documents of a shard are scored together. An item's terms are taken rarest first; each adds its part to the accumulators of the
documents that hold it. Once the terms that are left can give a new document less than the k-th partial score, no accumulator
is made any more, and the terms left only update the ones there are, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from chondria.llm.common import stored, text_of

#: Rows and bytes of text in a shard, at most; a longer text is a shard of its own.
DOCS, BYTES = 8192, 8 << 20
#: Items that are scored together, on average.
ITEMS = 1024
#: Parts into which the postings of each term are dealt when they meet the items; every part gets the term's items.
PARTS = 64
#: The term under which a shard keeps its documents: their ids and lengths. No text has an empty term.
ALL = ""
LONG = np.iinfo(np.int64)
#: ASCII letters and digits and all other characters make terms; A-Z become small, all else in ASCII separates.
TERMS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())
INDEX_FIELDS = "shard long, term string, n_docs long, n_terms long, docs binary, counts binary, ids binary, known binary"


def split(text: str) -> list[bytes]:
    return text.encode().translate(TERMS).split()


def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary for each stretch of ``values`` that ends at one of ``ends``."""
    offsets = np.append(0, ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def shard(number: int, ids: pa.Array, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Postings of some texts; texts without a term are left out."""
    held = [i for i, t in enumerate(texts) if t]
    if not held:
        return
    size = np.array([len(texts[i]) for i in held])
    flat = np.empty(int(size.sum()), object)
    flat[:] = [t for i in held for t in texts[i]]
    code, names = pd.factorize(flat)
    key, count = np.unique(code.astype(np.int64) * len(held) + np.repeat(np.arange(len(held)), size), return_counts=True)
    ends = np.searchsorted(key // len(held), np.arange(len(names)), "right")
    for i in range(0, len(names), DOCS):
        terms, last, first = names[i:i + DOCS], ends[i:i + DOCS], ends[i - 1] if i else 0
        a, b = key[first:last[-1]], count[first:last[-1]].astype(np.int32)
        own_ends = last - first
        n_docs = np.diff(np.append(0, own_ends))
        n_terms = np.diff(np.append(0, np.append(0, np.cumsum(b))[own_ends]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(terms), number)), pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array(n_docs, pa.int64()),
             pa.array(n_terms, pa.int64()), lists((a % len(held)).astype(np.int32), own_ends), lists(b, own_ends),
             pa.nulls(len(terms), pa.binary()), pa.nulls(len(terms), pa.binary())], names=[f.split()[0] for f in INDEX_FIELDS.split(", ")])
    own = ids.take(pa.array(held))
    yield pa.RecordBatch.from_pydict(
        {"shard": pa.array([number], pa.int64()), "term": [ALL], "n_docs": pa.array([len(held)], pa.int64()), "n_terms": pa.array([int(size.sum())], pa.int64()),
         "docs": [b""], "counts": [size.astype(np.int32).tobytes()], "ids": [own.fill_null(LONG.max).to_numpy().tobytes()],
         "known": [own.is_valid().to_numpy(zero_copy_only=False).tobytes()]})


def index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The postings of whole texts, by shard and term: documents (by place in the shard) and how often each holds the term.

    Shards are cut from the scan's partitions, without a shuffle. Store the result: a shard's number holds for one reading.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for i, t in enumerate(batch.column(1)):
                text = t.as_py()
                if texts and (len(texts) >= DOCS or size + len(text) > BYTES):
                    yield from shard(number, pa.array(ids, pa.int64()), texts)
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(batch.column(0)[i].as_py())
                texts.append(split(text))
                size += len(text)
        yield from shard(number, pa.array(ids, pa.int64()), texts)

    return df.select(df[id_col].cast("long").alias("id"), text_of(df, text_col).alias("text")).mapInArrow(run, INDEX_FIELDS)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, repeats) of (item, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                names, n = np.unique(np.array(split(text), object), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(names), pa.int64()), pa.array(list(names), pa.binary()).cast(pa.string()),
                                                  pa.array(n, pa.int64())], names=["item", "term", "repeats"])

    return items.mapInArrow(run, "item long, term string, repeats long")


def best_of(parts: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, k: int) -> np.ndarray:
    """Scores of the documents of a shard; those that end among the best ``k``, or tie with them, are exact and the others no higher.

    ``parts`` has (greatest part, documents, parts) of each term, rarest first.
    """
    left = np.cumsum([p[0] for p in parts][::-1])[::-1]     # the most that a term and all after it can give
    scores, made, making, given = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool), True, 0
    for i, (most, docs, part) in enumerate(parts):
        # The k-th partial score is at most what the terms so far can give.
        if making and given > left[i] and n_docs >= k and np.partition(scores, n_docs - k)[n_docs - k] > left[i]:
            making = False
        if making:
            made[docs] = True
        else:
            part, docs = part[made[docs]], docs[made[docs]]
        scores[docs] += part
        given += most
    return scores


def ranked_rows(rows: list[dict], n_docs: int, n_terms: int, k: int) -> Iterator[tuple]:
    """(item, doc_id, score) of the best ``k`` documents of a shard for each item that uses one of its terms."""
    docs = next(r for r in rows if r["term"] == ALL)
    size, ids = np.frombuffer(docs["counts"], np.int32).astype(np.int64), np.frombuffer(docs["ids"], np.int64)
    known = np.frombuffer(docs["known"], bool)
    m = 100 - 25 + 25 * size * n_docs // n_terms
    by_item = {}
    for r in sorted((r for r in rows if r["term"] != ALL), key=lambda r: (r["df"], r["term"])):
        place, tf = np.frombuffer(r["docs"], np.int32), np.frombuffer(r["counts"], np.int32).astype(np.int64)
        part = r["weight"] * (1_000_000_000 * tf // (1000 * tf + 12 * m[place]))
        most = int(part.max())
        for use in r["uses"]:
            by_item.setdefault(use["item"], []).append((use["repeats"] * most, place, part * use["repeats"] if use["repeats"] > 1 else part))
    for item, parts in by_item.items():
        scores = best_of(parts, len(size), k)
        found = np.flatnonzero(scores)
        if len(found) > k:
            found = found[scores[found] >= np.partition(scores[found], len(found) - k)[len(found) - k]]
        for d in found[np.lexsort((ids[found], ~known[found], -scores[found]))][:k].tolist():
            yield item, int(ids[d]) if known[d] else None, int(scores[d])


def search(postings: DataFrame, items: DataFrame, k: int = 20, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` highest-scoring documents of a stored :func:`index` for each row of ``items``.

    Terms are the runs of ASCII letters and digits and characters beyond ASCII, A-Z made small. Scores are whole numbers above 0; equal
    ones go by the smaller id, NULL ids last. Only the postings of terms that an item holds are read on. A shard is scored in one task for some
    items at a time; it sends on ``k`` rows an item. A common term's postings lie in many shards; they meet the term's items in ``PARTS`` parts.

    Items that are NULL, empty or without a known term give no rows; repeated items, and items with NULL id, are ranked each on its own. Documents that are NULL
    or without a term are in no count; repeated rows are documents of their own. Other columns aren't looked at.
    """
    spark = postings.sparkSession
    asked = stored(items.select(F.monotonically_increasing_id().alias("item"), items[item_col].alias("item_id"), text_of(items, text_col).alias("text")), "items")
    blocks = max(1, -(-asked.count() // ITEMS))
    terms = stored(item_terms(asked.select("item", "text")).withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), "terms")
    uses = (terms.groupBy("block", "term").agg(F.collect_list(F.struct("item", "repeats")).alias("uses"))
            .unionByName(terms.select("block").distinct().select("block", F.lit(ALL).alias("term"), F.expr("array()").cast("array<struct<item:long,repeats:long>>").alias("uses"))))
    hits = stored(postings.join(uses.select("term").distinct(), "term", "left_semi"), "postings")
    counts = hits.groupBy("term").agg(F.sum("n_docs").alias("df"), F.sum("n_terms").alias("all"))
    total = counts.where(F.col("term") == ALL).first()
    found = "item long, doc_id long, score long"
    if total is None:
        return spark.createDataFrame([], found).join(asked, "item").select("item_id", F.lit(0).alias("rank"), "doc_id", "score")
    n_docs, n_terms = total["df"], total["all"]
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weighted = uses.join(counts.select("term", "df", weight.alias("weight")), "term")

    def score(table: pa.Table) -> pa.Table:
        rows = list(zip(*ranked_rows(table.to_pylist(), n_docs, n_terms, k)))
        return pa.table([pa.array(c, pa.int64()) for c in rows or [()] * 3], names=["item", "doc_id", "score"])

    part = F.pmod(F.xxhash64("shard"), F.lit(PARTS))
    dealt = weighted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    scored = hits.withColumn("part", part).join(dealt, ["term", "part"]).groupBy("shard", "block").applyInArrow(score, found)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """:func:`search` over ``docs(doc_id, text)``, indexed and stored first."""
    return search(stored(index(docs), "index"), items, k)
