"""Bit filters over 64-bit keys: Bloom filters of bounded size, built by tasks and merged piece by piece.

A filter has at most ``MAX_BITS`` bits (32 MB), whatever the input. Up to about 16 million keys that is 16 bits a key; beyond,
more keys pass by chance. The callers stay exact, as a key that passes is only looked at more closely.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chondria.llm.common import forgotten, stored

PIECE = 1 << 16
MAX_BITS = 1 << 28
BITS_PER_KEY = 16


def places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions for each key; ``size`` is a power of two."""
    h = keys.astype(np.int64).view(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    a = (h >> np.uint64(7)) & np.uint64(size - 1)
    b = (h >> np.uint64(36)) & np.uint64(size - 1)
    return a, np.where(a == b, b ^ np.uint64(1), b)


def build(keys: DataFrame, n_keys: int, twice: bool) -> tuple[bytes, int]:
    """(bits, size) over the one ``long`` column of ``keys``: set where a key falls, or, with ``twice``, where two rows fall.

    With ``twice`` a row whose key comes again has both of its bits set, so it is found; a lone row is found only by chance.
    """
    size = min(MAX_BITS, max(PIECE, 1 << int(np.ceil(np.log2(max(1, n_keys) * BITS_PER_KEY)))))
    name = keys.columns[0]
    least = 2 if twice else 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            if not len(k):
                continue
            at, n = np.unique(np.concatenate(places(k, size)), return_counts=True)
            piece, n = (at // np.uint64(PIECE)).astype(np.int64), np.minimum(n, 2)
            cut = np.flatnonzero(np.diff(piece)) + 1
            inside = (at % np.uint64(PIECE)).astype("<u2")
            groups = zip(np.split(piece, cut), np.split(inside, cut), np.split(n, cut))
            rows = [(int(p[0]), x.tobytes(), x[m > 1].tobytes()) for p, x, m in groups]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
                                             names=["piece", "seen", "again"])

    def merge(table: pa.Table) -> pa.Table:
        n = np.zeros(PIECE, np.uint8)
        for seen, again in zip(table.column("seen").to_pylist(), table.column("again").to_pylist()):
            for part in (seen, again):
                at = np.frombuffer(part, "<u2")
                n[at] = np.minimum(n[at] + 1, 2)
        return pa.table({"piece": table.column("piece").slice(0, 1), "bits": [np.packbits(n >= least, bitorder="little").tobytes()]},
                        schema=pa.schema([("piece", pa.int64()), ("bits", pa.binary())]))

    pieces = (keys.select(F.col(name).cast("long")).mapInArrow(partial, "piece long, seen binary, again binary")
              .groupBy("piece").applyInArrow(merge, "piece long, bits binary"))
    # stored, as an iterator counts as ended before it is read, and where an operator frees its shuffles they would be deleted under it
    pieces = stored(pieces, "bits")
    bits = bytearray(size // 8)
    for row in pieces.toLocalIterator():
        bits[row.piece * PIECE // 8:(row.piece + 1) * PIECE // 8] = row.bits
    forgotten(pieces)
    return bytes(bits), size


def passes(key: Column, built: tuple[bytes, int]) -> Column:
    """Whether both bits of a key are set; only the key goes to Python."""
    bits, size = built

    @F.pandas_udf("boolean")
    def test(keys: pd.Series) -> pd.Series:
        table = np.frombuffer(bits, np.uint8)
        a, b = places(keys.to_numpy(), size)
        hit = [(table[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 for x in (a, b)]
        return pd.Series((hit[0] & hit[1]).astype(bool))

    return test(key)
