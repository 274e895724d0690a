"""Periodic runs of words inside a text: recursive frequency splitting, then a lag scan of what survives.

A run is a maximal stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical) that is at least
``max(least, 2 * q)`` words long. Every word of a run is there twice, so a word that stands alone in its segment is in no run
and splits it. Splitting makes other words stand alone, and goes on until nothing changes; pieces of fewer than ``least`` words
are dropped. Only the segments left are scanned: short lags by comparing the words one by one, longer lags where a block of
words comes again at that distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chondria.llm.common import text_of

LEAST = 12
#: Texts are worked on together up to this many bytes; a longer text is worked on alone.
BYTES = 4 << 20
#: Lags below this are compared word by word.
SHORT = 8


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``first .. first + size - 1``, one range after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def survivors(words: np.ndarray, first: np.ndarray, size: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the segments that stay when no word stands alone in its segment any more.

    ``words`` are the numbered words of all texts, one text after the other. A word stands alone if its neighbours among equal words of
    the text lie outside its segment. After a split only the smaller pieces and the words equal to one of theirs are looked at
    again, so all levels together take ``n log n`` steps, however deep the splitting goes.
    """
    n = len(words)
    text = np.repeat(np.arange(len(size)), size)
    order = np.argsort(text * (int(words.max(initial=0)) + 1) + words, kind="stable")
    same = (words[order][1:] == words[order][:-1]) & (text[order][1:] == text[order][:-1])
    before, after = np.full(n, -1), np.full(n, n)
    before[order[1:][same]], after[order[:-1][same]] = order[:-1][same], order[1:][same]
    segment, lo, hi = text, first.copy(), first + size
    alive = (hi - lo)[segment] >= least
    look = np.flatnonzero(alive)
    while len(look):
        s = segment[look]
        alone = look[(before[look] < lo[s]) & (after[look] >= hi[s])]
        cut, pieces = np.unique(segment[alone], return_counts=True)
        a = np.sort(np.concatenate([lo[cut], alone + 1]))
        b = np.sort(np.concatenate([alone, hi[cut]]))
        # Pieces in text order belong to the segments in the order of their starts.
        place = np.argsort(lo[cut])
        owner = np.repeat(cut[place], pieces[place] + 1)
        by_size = np.lexsort((b - a, owner))
        largest = by_size[np.append(owner[by_size][1:] != owner[by_size][:-1], True)] if len(owner) else by_size
        small = np.ones(len(a), bool)
        small[largest] = False
        alive[alone] = False
        lo[owner[largest]], hi[owner[largest]] = a[largest], b[largest]
        a, b = a[small], b[small]
        inside = spans(a, b - a)
        segment[inside] = np.repeat(len(lo) + np.arange(len(a)), b - a)
        lo, hi = np.concatenate([lo, a]), np.concatenate([hi, b])
        again = np.concatenate([inside, before[inside], after[inside]])
        look = np.unique(again[(again >= 0) & (again < n)])
        look = look[alive[look]]
        short = (hi - lo)[segment[look]] < least
        alive[look[short]] = False
        look = look[~short]
    kept = hi - lo >= least
    order = np.argsort(lo[kept])
    return lo[kept][order], hi[kept][order]


def lag_scan(x: np.ndarray, least: int) -> np.ndarray:
    """(start, length, period) of all runs of ``x``, which starts and ends with a number of its own, as rows by start and period.

    Lags from ``2 * s`` to ``4 * s`` are found by blocks of ``s`` numbers at multiples of ``s``: numbers that agree at such a
    lag over a stretch of that lag hold such a block, whose name comes again at the lag. Names are exact: a
    block's name numbers the pair of names of its halves. A block whose match lies in a run whose period divides the lag
    belongs to that run, and is passed over.
    """
    n = len(x)
    found = []
    for q in range(1, min(SHORT, n)):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], x[q:] == x[:-q], [False]]).astype(np.int8)))
        a, b = edge[::2], edge[1::2]
        long_ = b - a >= max(least - q, q)
        found.append(np.stack([a[long_], (b - a + q)[long_], np.full(int(long_.sum()), q)], 1))
    period, until = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def covered(runs: np.ndarray) -> None:
        for a, length, q in runs[runs[:, 1] >= 4 * runs[:, 2]].tolist():
            further = until[a:a + length] < a + length
            period[a:a + length][further] = q
            until[a:a + length][further] = a + length

    for runs in found:
        covered(runs)
    names = [np.unique(x, return_inverse=True)[1]]
    s = 1
    while 4 * s < n:
        if 2 * s >= SHORT:
            runs = _blocks(names, s, period, until, least)
            found.append(runs)
            covered(runs)
        last = names[-1]
        names.append(np.unique(last * n + last[np.minimum(np.arange(n) + s, n - 1)], return_inverse=True)[1])
        s *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(1))] if len(runs) else runs     # the smallest period of a stretch
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _blocks(names: list[np.ndarray], s: int, period: np.ndarray, until: np.ndarray, least: int) -> np.ndarray:
    """Stretches of lags ``2 * s .. 4 * s - 1``; ``names[k]`` are the names of the blocks of ``2 ** k`` numbers."""
    name, n = names[-1], len(names[-1])
    places = np.sort(name * n + np.arange(n))
    at = np.arange(0, n, s)
    left = np.searchsorted(places, name[at] * n + np.minimum(at + 2 * s, n))
    count = np.searchsorted(places, name[at] * n + np.minimum(at + 4 * s, n)) - left
    at, lag = np.repeat(at, count), places[spans(left, count)] % n - np.repeat(at, count)
    known = (period[at] > 0) & (lag % np.maximum(period[at], 1) == 0) & (until[at] >= at + lag + s)
    key = np.sort((lag * n + at)[~known])
    key = key[np.append(True, np.diff(key) != s)] if len(key) else key      # neighbouring blocks lie in one stretch
    lag, a = key // n, key % n
    b = a + s
    for step, tag in ((s, name), *((2 ** k, names[k]) for k in range(len(names) - 2, -1, -1))):
        open_ = np.arange(len(a))
        while len(open_):
            i, j = b[open_], b[open_] + lag[open_]
            open_ = open_[(j < n) & (tag[i] == tag[np.minimum(j, n - 1)])]
            b[open_] += step
            open_ = open_ if step == s else open_[:0]
        open_ = np.arange(len(a))
        while len(open_):
            i = a[open_] - step
            open_ = open_[(i >= 0) & (tag[i] == tag[i + lag[open_]])]
            a[open_] -= step
            open_ = open_ if step == s else open_[:0]
    long_ = b - a >= np.maximum(least - lag, lag)
    return np.unique(np.stack([a, b - a + lag, lag], 1)[long_], axis=0)


def runs_of(words: np.ndarray, first: np.ndarray, size: np.ndarray, least: int) -> np.ndarray:
    """(start, length, period) of the runs of all texts, by start and period; starts count over all texts."""
    lo, hi = survivors(words, first, size, least)
    if not len(lo):
        return np.zeros((0, 3), np.int64)
    # Segments one after the other, each followed by a number of its own.
    length = hi - lo
    x = np.empty(int(length.sum()) + len(lo) + 1, np.int64)
    start = np.cumsum(length + 1) - length
    ends = np.append(0, start + length)
    x[spans(start, length)] = words[spans(lo, length)]
    x[ends] = -1 - np.arange(len(ends))
    runs = lag_scan(x, least)
    runs[:, 0] += (lo - start)[np.searchsorted(start, runs[:, 0], "right") - 1]
    return runs


def _rows(texts: list[bytes], least: int) -> Iterator[tuple[int, list[dict], str]]:
    """(number of words, runs, text without what runs repeat) of each text."""
    split = [t.split() for t in texts]      # bytes are split at the six ASCII blanks alone
    size = np.array([len(w) for w in split], np.int64)
    first = np.cumsum(size) - size
    flat = np.empty(int(size.sum()), object)
    flat[:] = [w for ws in split for w in ws]
    runs = runs_of(pd.factorize(flat)[0].astype(np.int64), first, size, least)
    steps = np.zeros(len(flat) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(steps)[:-1] == 0
    text = np.searchsorted(first, runs[:, 0], "right") - 1
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    for i, ws in enumerate(split):
        own = runs[bounds[i]:bounds[i + 1]]
        if len(own):
            ws = compress(ws, keep[first[i]:first[i] + size[i]].tolist())
        yield int(size[i]), [{"start": a - int(first[i]), "length": n, "period": q} for a, n, q in own.tolist()], b" ".join(ws).decode()


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(``id_col``, n_words, runs, collapsed) of every row, in one pass without a shuffle.

    ``runs`` lists start (word number from 0), length and period by start, then period. ``collapsed`` are the words, joined by
    one space, without those that a run repeats: all of a run after its first ``period`` words. Words are ``[^\\x20\\x09-\\x0D]+``.

    NULL, empty and blank texts have no words, no runs and collapse to the empty text; a NULL id stays NULL. Texts never meet, so
    repeated rows have equal results. A text of any length is worked on whole, with memory in proportion to it and
    time in ``n log n``. Columns other than the two aren't looked at; an empty table gives an empty result.
    """
    fields = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py().encode() for t in batch.column(1)]
            part = np.cumsum([0, *map(len, texts)][:-1]) // BYTES if texts else np.zeros(0)
            for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(part)) + 1):
                if len(rows):
                    n, found, kept = zip(*_rows([texts[i] for i in rows], least))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(int(rows[0]), len(rows)), pa.array(n, pa.int64()), pa.array(found, fields),
                                                      pa.array(kept, pa.string())], names=["id", "n_words", "runs", "collapsed"])

    source = df.select(df[id_col].alias("id"), text_of(df, text_col).alias("text"))
    out = source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, n_words long, "
                                 "runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)
