"""Exact top-k search by inner product: columnar branch and bound.

Vectors lie in blocks in vertical layout, one run of numbers a dimension. For a few queries at a time the scores of a block's vectors
are summed up some dimensions at a time, those of the greatest mass first. What the remaining dimensions can still add is at most the product
of the remaining lengths of query and vector (Cauchy-Schwarz); vectors that can't reach the k-th score of any of these queries are
left out, and the columns still to come are compacted to the survivors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from chondria.llm.common import shuffle_partitions, stored

#: Vectors and bytes in a block, at most; a longer vector is a block of its own.
BLOCK, BLOCK_BYTES = 1024, 4 << 20
#: Bytes of vectors and of queries that meet in one task, on average.
GROUP_BYTES, QUERY_BYTES = 64 << 20, 8 << 20
#: Queries searched together, and dimensions summed up between two looks at the bounds.
TOGETHER, STEP = 64, 16
LONG = np.iinfo(np.int64)
BLOCK_FIELDS = "block long, dims int, kind string, ids binary, known binary, wanted binary, data binary"
QUERY_FIELDS = "block long, dims int, kind string, ids binary, places binary, floors binary, data binary"


def whole_numbers(x: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` in the smallest type that holds them all; held at the ends of a long."""
    y = np.floor(scale * x)
    y = np.where(y >= 2.0 ** 63, LONG.max, np.clip(y, -2.0 ** 63, 2.0 ** 63 - 1024).astype(np.int64))
    for kind in (np.int8, np.int16, np.int32):
        if not y.size or (y.min() >= np.iinfo(kind).min and y.max() <= np.iinfo(kind).max):
            return y.astype(kind)
    return y


def cuts(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose vectors, filled up to one length, keep to the bounds of a block."""
    start, most = 0, 0
    for i, n in enumerate(size.tolist()):
        most = max(most, n)
        if i > start and (i - start >= BLOCK or 8 * most * (i - start + 1) > BLOCK_BYTES):
            yield start, i
            start, most = i, n
    if len(size):
        yield start, len(size)


def matrices(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows that take part, their components filled up with zeros to one length), a block at a time."""
    offset, value = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    odd = np.append(0, np.cumsum(~np.isfinite(value)))[offset]
    rows = np.flatnonzero((np.diff(odd) == 0) & ~lists.is_null().to_numpy(zero_copy_only=False))
    sizes = np.diff(offset)[rows]
    for i, j in cuts(sizes):
        size, first = sizes[i:j, None], offset[rows[i:j], None]
        place = np.arange(int(size.max()))
        out = np.zeros((j - i, len(place)))
        out[place < size] = value[(first + place)[place < size]]
        yield rows[i:j], out


def blocks(df: DataFrame, wanted: Column, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Blocks of vectors in vertical layout. ``wanted`` marks the vectors that are queries, too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, x in matrices(batch.column(1)):
                own, v = batch.take(pa.array(rows)), whole_numbers(x, scale).T
                parts = [own.column(0).fill_null(LONG.max).to_numpy(), own.column(0).is_valid().to_numpy(zero_copy_only=False),
                         own.column(2).to_numpy(zero_copy_only=False).astype(bool), v]
                yield pa.RecordBatch.from_pydict({"block": pa.array([number]), "dims": pa.array([v.shape[0]], pa.int32()), "kind": [v.dtype.str]}
                                                 | {c: [p.tobytes()] for c, p in zip(("ids", "known", "wanted", "data"), parts)})
                number += 1

    source = df.select(df[id_col].cast("long").alias("id"), df[vector_col].cast("array<double>").alias("v"), F.coalesce(wanted, F.lit(False)).alias("w"))
    return source.mapInArrow(run, BLOCK_FIELDS)


def columns(row: dict) -> np.ndarray:
    """The numbers of a block, a row for each dimension."""
    return np.frombuffer(row["data"], row["kind"]).reshape(row["dims"], len(row["ids"]) // 8)


def safe_type(q: np.ndarray, v: np.ndarray) -> type:
    """A type in which every sum of products of the two is exact."""
    most = [max(float(x.max(initial=0)), -float(x.min(initial=0))) for x in (q, v)]
    top = most[0] * most[1] * max(1, v.shape[0])
    return np.float32 if top < 2 ** 24 else np.float64 if top < 2 ** 53 else object


def tails(x: np.ndarray) -> np.ndarray:
    """Length of each row's rest from each step on, and 0 behind the last."""
    squares = np.add.reduceat(x.astype(float) ** 2, range(0, x.shape[1], STEP), axis=1) if x.shape[1] else np.zeros((len(x), 0))
    return np.append(np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]), np.zeros((len(x), 1)), axis=1)


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th score of each row, never rounded up; minus infinity where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    if scores.dtype == object:
        return np.nextafter(np.sort(scores, axis=1)[:, -k].astype(float), -np.inf)
    return np.partition(scores, -k, axis=1)[:, -k].astype(float)


def as_longs(scores: np.ndarray) -> np.ndarray:
    return np.array([max(LONG.min, min(LONG.max, s)) for s in scores.tolist()], np.int64) if scores.dtype == object else scores.astype(np.int64)


def survivors(q: np.ndarray, v: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the vectors that may reach ``floor`` for some query, whole scores of each query and those vectors)."""
    dims = min(q.shape[1], v.shape[0])
    q, v = q[:, :dims], v[:dims]
    kind = safe_type(q, v)
    by_mass = np.argsort(-(v.astype(float) ** 2).sum(axis=1), kind="stable")
    q, v = q[:, by_mass], v[by_mass]
    q_rest, v_rest = tails(q), tails(v.T)
    left = np.arange(v.shape[1])
    scores = np.zeros((len(q), len(left)), kind)
    for step, first in enumerate(range(0, dims, STEP)):
        part = slice(first, first + STEP)
        scores += q[:, part].astype(kind) @ v[part][:, left].astype(kind)
        # Rounded upwards, so that no vector that ties is lost.
        reach = scores + (np.outer(q_rest[:, step + 1], v_rest[left, step + 1]) * (1 + 1e-5) + 1)
        keep = (reach >= floor[:, None]).any(axis=0)
        if not keep.all():
            left, scores = left[keep], scores[:, keep]
    return left, scores


def queries_of(stored_blocks: DataFrame, k: int) -> DataFrame:
    """The vectors that are queries, by block, with a floor each: its k-th score within its block, which the k-th of all can't be below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place = np.flatnonzero(np.frombuffer(row["wanted"], bool))
                if not len(place):
                    continue
                v = columns(row)
                floor = np.empty(len(place))
                for i in range(0, len(place), TOGETHER):
                    at = place[i:i + TOGETHER]
                    _, scores = survivors(v[:, at].T, v, np.full(len(at), -np.inf))
                    scores[np.arange(len(at)), at] = -np.inf
                    floor[i:i + TOGETHER] = kth(scores, k)
                parts = [np.frombuffer(row["ids"], np.int64)[place], place, floor, v[:, place]]
                yield pa.RecordBatch.from_pydict({"block": pa.array([row["block"]]), "dims": pa.array([row["dims"]], pa.int32()), "kind": [row["kind"]]}
                                                 | {c: [p.tobytes()] for c, p in zip(("ids", "places", "floors", "data"), parts)})

    return stored_blocks.mapInArrow(run, QUERY_FIELDS)


def top_of(block_rows: list[dict], query_rows: list[dict], k: int) -> Iterator[tuple]:
    """(block and place of the query, its id, id of the vector, score) of the best ``k`` of these blocks for each of these queries."""
    for row in query_rows:
        ids, places, floors = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["places"], np.int64), np.frombuffer(row["floors"], float)
        for i in range(0, len(ids), TOGETHER):
            at, floor, q = places[i:i + TOGETHER], floors[i:i + TOGETHER].copy(), columns(row)[:, i:i + TOGETHER].T
            best = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
            for block in block_rows:
                left, scores = survivors(q, columns(block), floor)
                if block["block"] == row["block"] and len(left):      # a query is no candidate of its own
                    spot = np.minimum(np.searchsorted(left, at), len(left) - 1)
                    own = np.flatnonzero(left[spot] == at)
                    scores[own, spot[own]] = -np.inf
                floor = np.maximum(floor, kth(scores, k))
                a, b = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
                found = [a, as_longs(scores[a, b]), np.frombuffer(block["ids"], np.int64)[left[b]], np.frombuffer(block["known"], bool)[left[b]]]
                best = [np.concatenate(x) for x in zip(best, found)]
                order = np.lexsort((best[2], ~best[3], ~best[1], best[0]))
                best = [x[order] for x in best]
                rank = np.arange(len(order)) - np.searchsorted(best[0], best[0])
                last = rank == k - 1
                floor[best[0][last]] = np.maximum(floor[best[0][last]], np.nextafter(best[1][last].astype(float), -np.inf))
                best = [x[rank < k] for x in best]
            for a, score, vec, known in zip(*(x.tolist() for x in best)):
                yield row["block"], int(at[a]), int(ids[i + a]), vec if known else None, score


def top_k(df: DataFrame, wanted: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products of ``floor(scale * component)`` for each row that ``wanted`` marks.

    Every row but the query's own is a candidate; equal scores go by the smaller id. Vectors are laid out in blocks and stored once.
    Groups of blocks meet groups of queries in tasks of bounded bytes, as many as the sizes ask for; each query brings along its k-th score
    within its own block, so a task sends on only what can still be among the best.

    Ids are whole numbers. A row with NULL id is never a query if ``wanted`` says nothing of it; as a candidate it comes after equal scores.
    Vectors that are NULL or hold a NULL or non-finite component take no part. The shorter of two vectors counts as filled up with zeros, and an
    empty one scores 0. Repeated ids are rows of their own. Scaled components and scores beyond a long are held at its ends.
    An empty table, or one without queries, gives no rows. Other columns aren't looked at.
    """
    laid = stored(blocks(df, wanted, id_col, vector_col, scale), "vectors")
    asked = stored(queries_of(laid, k), "queries")
    size = [t.agg(F.sum(F.octet_length("data")).alias("n")).first().n or 0 for t in (laid, asked)]
    across = max(shuffle_partitions(df.sparkSession), -(-size[0] // GROUP_BYTES))
    down = max(1, -(-size[1] // QUERY_BYTES))

    def dealt(side: DataFrame, own: int, other: int, cell: str) -> DataFrame:
        """Each row to all cells of its line; ``g`` is its line, ``o`` the cell's place in it."""
        group = F.pmod(F.xxhash64("block"), F.lit(own)).alias("g")
        rows = side.select("*", group, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other - 1).cast("long"))).alias("o"))
        return rows.withColumn("cell", F.expr(cell)).drop("g", "o")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = list(zip(*top_of(left.to_pylist(), right.to_pylist(), k)))
        names = ("block", "place", "query_id", "vec_id", "score")
        return pa.table([pa.array(c, pa.int64()) for c in rows or [()] * 5], names=names)

    left = dealt(laid, across, down, f"g + o * {across}")
    right = dealt(asked, down, across, f"o + g * {across}")
    found = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(search, "block long, place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
