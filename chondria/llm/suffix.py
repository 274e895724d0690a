"""Removal of long repeated strings, by refining buckets of equal prefixes as in suffix sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chondria.llm import bits
from chondria.llm.common import stored, text_of

LENGTH = 400            # bytes of a string that counts as repeated
GRAM = 64               # bytes of the initial buckets
HOT = 4096              # contexts of a bucket that one task refines; larger buckets are refined by Spark's own aggregates
PART_ROWS = 4096        # contexts that a task is to have
HEAVY, SALTS = 256, 64  # rows of one key beyond which a join deals them to that many parts
SEGMENT = 1 << 19
LOW = np.uint64((1 << 20) - 1)
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray, multiplier: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(multiplier)
    return x ^ (x >> np.uint64(29))


def identifiers(data: np.ndarray, upto: int, multiplier: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, bucket identifiers of the strings of that length at every position), for 8, 16, 32 .. and then ``upto`` itself.

    The identifier of a longer string is made from those of the shorter one at its start and at a later offset: equal strings get equal
    identifiers, and each doubling reuses the last one.
    """
    if len(data) < 8:
        return
    words = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
    now, length = mixed(words ^ np.uint64(0x51ED270B0A1F39C1), multiplier), 8
    while True:
        yield length, now
        if length >= upto:
            return
        later = min(length, upto - length)
        if len(now) <= later:
            return
        now = mixed((now[:-later] << np.uint64(1) | now[:-later] >> np.uint64(63)) * np.uint64(MULTIPLIERS[0]) + now[later:], multiplier)
        length += later


def last(data: np.ndarray, upto: int, multiplier: int) -> np.ndarray:
    found = np.zeros(0, np.uint64)
    for length, now in identifiers(data, upto, multiplier):
        if length == upto:
            found = now
    return found


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n - width + 1], behind[width - 1:n])


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first, last, anchor, bucket) of each run of starts: the strings of ``length`` bytes that start there have the same least q-gram.

    A string's anchor depends on its own bytes only, so equal strings have their anchors at the same offset and in the same bucket.
    """
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    grams, width = last(data, gram, MULTIPLIERS[0]), length - gram + 1
    starts = len(data) - length + 1
    at = np.empty(starts, np.int64)
    for i in range(0, starts, SEGMENT):
        part = grams[i:min(i + SEGMENT, starts) + width - 1]
        packed = (part & ~LOW) | (LOW - np.arange(len(part), dtype=np.uint64))      # of equal ones the rightmost
        least = sliding_minimum(packed, width)
        at[i:i + len(least)] = i + (LOW - (least & LOW)).astype(np.int64)
    cut = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate(([0], cut))
    return first, np.concatenate((cut - 1, [starts - 1])), at[first], grams[at[first]].view(np.int64)


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, the offsets at which a string of ``length`` bytes starts that also starts elsewhere in the contexts.

    Bucket refinement: positions whose identifier is alone are settled; the others go on with the identifier that takes in
    the bucket at a later offset, up to ``length``.
    """
    offsets = np.cumsum([0, *map(len, contexts)])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    counts = np.array([len(c) - length + 1 for c in contexts])
    where = np.concatenate([np.arange(o, o + n) for o, n in zip(offsets, counts)])
    check = last(data, length, MULTIPLIERS[1])
    for reached, now in identifiers(data, length, MULTIPLIERS[0]):
        if reached < GRAM or not len(where):
            continue
        keys = now[where]
        order = np.argsort(keys, kind="stable")
        keys, others = keys[order], check[where[order]] if reached == length else None
        if others is not None:
            order2 = np.lexsort((others, keys))
            order, keys, others = order[order2], keys[order2], others[order2]
        same = keys[1:] == keys[:-1]
        if others is not None:
            same &= others[1:] == others[:-1]
        again = np.zeros(len(keys), bool)
        again[1:] |= same
        again[:-1] |= same
        where = np.sort(where[order[again]])
    cuts = np.searchsorted(where, offsets)
    return [where[a:b] - o for a, b, o in zip(cuts, cuts[1:], offsets)]


def runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of consecutive numbers."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(), starts[np.concatenate((cut, [len(starts) - 1]))].tolist()))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by half-open spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def spread_join(rows: DataFrame, lines: DataFrame, on: list[tuple[str, str]], count: str, by: list[str]) -> DataFrame:
    """``rows`` joined with ``lines``, which has a row per key and says in ``count`` how many rows have it.

    The rows of a key that more than ``HEAVY`` have are dealt to ``SALTS`` parts by the columns ``by``, and its line is repeated for each. A bit filter tells such
    keys; others that pass it are treated alike on both sides. Its bits grow with the heavy keys, of which there are at most rows / ``HEAVY``.
    """
    ours, theirs = (F.xxhash64(*names) for names in zip(*on))
    heavy = stored(lines.where(F.col(count) > HEAVY).select(theirs.alias("k")), "heavy")
    filter_ = bits.build(heavy, heavy.count(), twice=False)
    part = F.pmod(F.xxhash64(*by), F.lit(SALTS))
    left = rows.withColumn("_many", bits.passes(ours, filter_)).withColumn("_part", F.when(F.col("_many"), part).otherwise(0)).drop("_many")
    every = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    right = lines.withColumn("_many", bits.passes(theirs, filter_)).withColumn(
        "_to", F.explode(F.when(F.col("_many"), every).otherwise(F.array(F.lit(0).cast("long"))))).drop("_many")
    same = F.col("_part") == F.col("_to")
    for a, b in on:
        same = same & (F.col(a) == F.col(b))
    return left.join(right, same).drop("_part", "_to")


def spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, tkey, start, stop): spans of bytes, overlapping ones too, that cover each repeated string of ``texts(id, tkey, text)``.

    ``id`` and ``tkey``, a hash of the text, together name a row; rows with both equal are copies. Steps:

    1. Every text is cut into runs of starts with the same anchor, the least q-gram of the string from there. Anchors are the initial buckets,
       one row for some 170 bytes; those in a bucket alone are dropped, as none of their strings is repeated.
    2. What is left brings its context, the bytes of all strings of the run. Equal contexts are one class, counted by a partial aggregate;
       if two rows have it, all of its strings are repeated.
    3. Classes of one bucket are refined: identifiers of their strings double in length, and strings that are alone drop out. Buckets are packed
       into tasks of bounded size; a bucket with more than ``HOT`` classes is not given to a task, its strings are counted by Spark.

    No task holds a group of unbounded size, and no pair is ever made: rows of a string or context that very many have meet its line in parts.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column(2)[row].as_buffer(), np.uint8)
                first, final, at, bucket = anchors(data, length, gram)
                if len(first):
                    names = [pa.array(np.full(len(first), batch.column(k)[row].as_py(), np.int64)) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*names, *[pa.array(x.astype(np.int32)) for x in (first, final, at)], pa.array(bucket)],
                                                     names=["id", "tkey", "first", "final", "at", "bucket"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in cut(batches):
            held.append(batch)
            if len(held) == 512:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    row_key = F.xxhash64("id", "tkey")
    found = stored(texts.where(F.octet_length("text") >= length).mapInArrow(packed, "id long, tkey long, first int, final int, at int, bucket long"), "anchors")
    # stored, so that both sides of the join are shuffled for it, and a hot bucket can be split
    shared = stored(found.groupBy(F.col("bucket").alias("b")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("b"), "shared")
    active = found.join(shared, F.col("bucket") == F.col("b")).groupBy("id", "tkey").agg(
        F.collect_set(F.struct("first", "final", "at", "bucket")).alias("runs"))      # copies of a row add nothing
    active = stored(active, "active")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py()
                for run in batch.column(3)[row].as_py():
                    piece = text[run["first"]:run["final"] + length]
                    label = hashlib.blake2b(piece + (run["at"] - run["first"]).to_bytes(4, "little"), digest_size=16).digest()
                    rows.append((batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), run["first"], run["final"], run["bucket"], label, piece))
                if len(rows) > 4000 or row == batch.num_rows - 1 and rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                    rows = []

    names = ["id", "tkey", "first", "final", "bucket", "label", "piece"]
    schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))))
    likely = bits.build(active.select(row_key.alias("k")), active.count(), twice=False)
    some = texts.where(bits.passes(row_key, likely))
    held = active.select(F.col("id").alias("i"), F.col("tkey").alias("t"), "runs")
    met = some.join(held, (F.col("id") == F.col("i")) & (F.col("tkey") == F.col("t"))).select("id", "tkey", "text", "runs")
    pieces = stored(met.mapInArrow(contexts, "id long, tkey long, first int, final int, bucket long, label binary, piece binary"), "contexts")

    classes = stored(pieces.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("piece"),
                                                           F.min(F.struct("id", "tkey", "first")).alias("one")), "classes")
    whole = spread_join(pieces.select("id", "tkey", "first", "final", "label"), classes.where("n > 1").select(F.col("label").alias("l"), F.col("n").alias("c")),
                        [("label", "l")], "c", ["id", "tkey", "first"])
    whole = whole.select("id", "tkey", F.col("first").alias("start"), (F.col("final") + length).alias("stop"))

    sizes = classes.groupBy(F.col("bucket").alias("b")).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    open_ = stored(classes.join(sizes, F.col("bucket") == F.col("b")).select("bucket", "m", "n", "piece", "one.*"), "open")
    parts = max(1, open_.count() // PART_ROWS)

    def refine(table: pa.Table) -> pa.Table:
        out = []
        rows = zip(*(table.column(c).to_pylist() for c in ("n", "id", "tkey", "first")))
        for (n, id_, tkey, first), starts in zip(rows, repeated_starts(table.column("piece").to_pylist(), length)):
            if n == 1:
                out += [{"id": id_, "tkey": tkey, "start": first + a, "stop": first + b + length} for a, b in runs(starts)]
        return pa.Table.from_pylist(out, pa.schema([("id", pa.int64()), ("tkey", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]))

    refined = (open_.where(F.col("m") <= HOT).withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(parts)))
               .groupBy("part").applyInArrow(refine, "id long, tkey long, start int, stop int"))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column(4)[row].as_buffer(), np.uint8)
                a, b = (last(data, length, m) for m in MULTIPLIERS)
                values = [batch.column(k)[row].as_py() for k in range(4)]
                cells = [np.full(len(a), values[k], np.int64) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cells), pa.array((values[3] + np.arange(len(a))).astype(np.int32)),
                                                  pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["n", "id", "tkey", "start", "a", "b"])

    hot = open_.where(F.col("m") > HOT).select("n", "id", "tkey", "first", "piece").mapInArrow(
        strings, "n long, id long, tkey long, start int, a long, b long")
    again = stored(hot.groupBy(F.col("a").alias("x"), F.col("b").alias("y")).agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "again")
    counted = spread_join(hot.where("n = 1"), again, [("a", "x"), ("b", "y")], "c", ["id", "tkey", "start"]).select(
        "id", "tkey", "start", (F.col("start") + length).alias("stop"))
    return whole.unionByName(refined).unionByName(counted)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(``id_col``, n_bytes, n_removed, n_spans, kept) for every row: kept are the bytes that no repeated string covers.

    A string of ``length`` bytes is repeated when it also starts anywhere else, in the same text or another, overlapping or not. Strings are judged on
    the input. NULL text counts as empty; texts shorter than ``length`` are kept whole. Repeated rows are each other's copies, and so lose
    everything from ``length`` bytes on. A NULL id is an id of its own. Extra columns, whatever their names, are not looked at. An empty table
    gives an empty result. ``id_col`` must be a whole number.

    Texts without repeated strings pass straight through; a bit filter keeps them out of the shuffle that brings spans and texts together.
    """
    source = df.select(df[id_col].cast("long").alias("real"), text_of(df, text_col).cast("binary").alias("text"))
    rows = source.select("real", F.coalesce("real", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("tkey"), "text")
    found = stored(spans(rows.select("id", "tkey", "text"), length).groupBy("id", "tkey").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    row_key = F.xxhash64("id", "tkey")
    marked = rows.withColumn("some", bits.passes(row_key, bits.build(found.select(row_key.alias("k")), found.count(), twice=False)))
    free = marked.where("not some").select(F.col("real").alias(id_col), F.octet_length("text").cast("long").alias("n_bytes"),
                                           F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("text").alias("kept"))
    held = found.select(F.col("id").alias("i"), F.col("tkey").alias("t"), "spans")
    met = marked.where("some").join(held, (F.col("id") == F.col("i")) & (F.col("tkey") == F.col("t")), "left").select("real", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for real, text, covered in zip(*(batch.column(k) for k in range(3))):
                text = text.as_py()
                gone = merged([(s["start"], s["stop"]) for s in covered.as_py() or []])
                edges = [0, *(x for span in gone for x in span), len(text)]
                rows.append((real.as_py(), len(text), sum(b - a for a, b in gone), len(gone),
                             b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)],
                                             names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    return free.unionByName(met.mapInArrow(remove, f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept binary"))
