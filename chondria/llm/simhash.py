"""Near-duplicates by SimHash fingerprints, found with vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chondria.llm.common import stored, text_of
from chondria.llm.components import components

WIDTH = 3
DISTANCE = 2
SHARD_ROWS = 8192       # fingerprints that a shard is to have
SAMPLE_PER_SHARD = 64   # fingerprints that the upper tree is fitted on, for each shard
MAX_SAMPLE = 1 << 17    # bound of that sample
LEAF = 256              # within a shard: pieces of this size are compared in full
CHUNK = 1 << 22         # cells of one block of comparisons


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = text.lower().split()        # of bytes: A-Z only, and split at \\x20 \\x09-\\x0D only
    if not words:
        return 0
    if len(words) < width:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
        n = len(words) - width + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), "<u8", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(x.as_py(), width) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])

    source = df.select(df[id_col].alias("id"), text_of(df, text_col).cast("binary").alias("text"))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, fp long")


def split(points: np.ndarray, mask: np.uint64, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that halve ``points`` best, or None when nothing divides them."""
    best = None
    for v in rng.choice(points, min(8, len(points)), replace=False):
        d = np.bitwise_count((points ^ v) & mask)
        for mu in {int(np.median(d)), max(0, int(np.median(d)) - 1)}:
            inside = int((d <= mu).sum())
            cost = max(inside, len(points) - inside) + int((d == mu).sum())
            if 0 < inside < len(points) and (best is None or cost < best[0]):
                best = cost, v, mu
    return None if best is None or best[0] > 0.95 * len(points) else best[1:]


def fit(sample: np.ndarray, mask: np.uint64, leaves: int, rng: np.random.Generator, nodes: list) -> int:
    """Adds a tree over ``sample`` to ``nodes`` and returns its root: (vantage, radius, near, far), or None for a shard."""
    at = len(nodes)
    nodes.append(None)
    cut = split(sample, mask, rng) if leaves > 1 and len(sample) > 1 else None
    if cut:
        near = np.bitwise_count((sample ^ cut[0]) & mask) <= cut[1]
        nodes[at] = (*cut, fit(sample[near], mask, leaves // 2, rng, nodes), fit(sample[~near], mask, leaves // 2, rng, nodes))
    return at


def branch(points: np.ndarray, home: np.ndarray, v: np.uint64, mu: int, mask: np.uint64, radius: int) -> tuple:
    """Which points go to the near and the far side, and whether at home there.

    By the triangle inequality a partner of x within ``radius`` lies between d(x, v) - radius and d(x, v) + radius. Of two points on
    either side, the near one visits the far side; a visitor goes wherever its bounds reach.
    """
    d = np.bitwise_count((points ^ v) & mask).astype(np.int64)
    near = np.where(home, d <= mu, d <= mu + radius)
    far = d > mu - radius
    return near, home & near, far | (home & ~near), home & (d > mu)


def route(points: np.ndarray, nodes: list, root: int, mask: np.uint64, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, points, at home) for all shards that a point belongs to or may have partners in."""
    stack = [(root, points, np.ones(len(points), bool))]
    while stack:
        at, x, home = stack.pop()
        if not len(x):
            continue
        if nodes[at] is None:
            yield at, x, home
            continue
        v, mu, near, far = nodes[at]
        go_near, near_home, go_far, far_home = branch(x, home, v, mu, mask, radius)
        stack += [(near, x[go_near], near_home[go_near]), (far, x[go_far], far_home[go_far])]


def union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of ``a`` and ``b``; a label is the smallest index of its class, after the last step."""
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def link_shard(points: np.ndarray, home: np.ndarray, mask: np.uint64, radius: int, distance: int) -> np.ndarray:
    """A label for each point of a shard; points within ``distance``, one of them at home, share it. The tree goes on here."""
    label, rng = np.arange(len(points)), np.random.default_rng(7)
    stack = [(np.arange(len(points)), home)]
    while stack:
        at, own = stack.pop()
        if not own.any() or len(at) < 2:
            continue
        x = points[at]
        cut = split(x[own], mask, rng) if own.sum() > LEAF else None
        if cut:
            go_near, near_home, go_far, far_home = branch(x, own, *cut, mask, radius)
            if max(go_near.sum(), go_far.sum()) < 0.95 * len(at):
                stack += [(at[go_near], near_home[go_near]), (at[go_far], far_home[go_far])]
                continue
        mine = at[own]
        step = max(1, CHUNK // len(at))
        for i in range(0, len(mine), step):
            part = mine[i:i + step]
            r, c = np.nonzero(np.bitwise_count(points[part][:, None] ^ x[None, :]) <= distance)
            union(label, part[r], at[c])
    return label


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that join all of the distinct ``prints(fp)`` within ``distance`` bits; a forest for each shard, not all pairs.

    Two fingerprints within ``distance`` bits differ in at most half as many bits of their lower or of their upper word. So there is a tree
    for each word, whose distance is Hamming's on that word, and whose radius is half: the narrower bound prunes far more
    branches. What it leaves is compared in all 64 bits. The upper levels of the trees are fitted on a bounded sample and deal all
    fingerprints out to shards; a shard's task continues its tree.
    """
    n = prints.count()
    shards = 1 << max(0, int(np.ceil(np.log2(max(1, n) / SHARD_ROWS))))
    m = min(MAX_SAMPLE, max(1024, shards * SAMPLE_PER_SHARD))
    sample = np.array([r.fp for r in prints.orderBy(F.xxhash64("fp"), "fp").limit(m).collect()], np.int64).view(np.uint64)
    words = [np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)]
    radius, rng, nodes, roots = distance // 2, np.random.default_rng(11), [], []
    for mask in words:
        roots.append(fit(sample, mask, min(shards, m // 16), rng, nodes))
    upper = roots[1]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint64)
            for mask, root in zip(words, roots):
                for shard, points, home in route(x, nodes, root, mask, radius):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(points), shard, np.int32)), pa.array(points.view(np.int64)), pa.array(home)], names=["shard", "fp", "home"])

    def search(table: pa.Table) -> pa.Table:
        points = table.column("fp").to_numpy().view(np.uint64)
        mask = words[int(table.column("shard")[0].as_py() >= upper)]
        label = link_shard(points, table.column("home").to_numpy(), mask, radius, distance)
        other = label != np.arange(len(label))
        return pa.table({"a": points[other].view(np.int64), "b": points[label[other]].view(np.int64)})

    dealt = prints.select("fp").mapInArrow(deal, "shard int, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(search, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    distance: int = DISTANCE) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row: the smallest id that links reach.

    Rows with the same fingerprint are one node, so copies are never paired. NULL, empty and blank texts have fingerprint 0 and link
    like others. A NULL id gets the class of its fingerprint (NULL if no row of its class has an id). Repeated rows come out as
    often as they came in. Extra columns, whatever their names, are not looked at. An empty table gives an empty result.
    """
    rows = stored(fingerprints(df, id_col, text_col, width), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = components(links(nodes, distance))
    # a node outside of all links is its own class; the others meet their root's class
    classed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = classed.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("smallest"))
    answer = stored(classed.join(smallest, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "smallest"), "classes")
    return rows.join(answer, rows.fp == answer.f).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("smallest").alias("component_id"))
