"""Toxicity scores: bags of subword vectors, averaged into a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chondria.llm.common import text_of

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS  # rows of the table of subword vectors
DIMENSIONS = 8
GRAMS = (3, 4, 5)
SPAN = 8                # words that are averaged
STEP = 4                # words from one span to the next
SAMPLE = 3000           # labelled rows of each class that the model is fitted on, at most
SAMPLE_BYTES = 64 << 20 # of their texts, at most
EPOCHS = 8
WARM = 2                # of these, the first, in which any of a text's spans learn
BATCH = 128
PRIME = np.uint64(0x9E3779B97F4A7C15)


def grams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, at, first, end): the table rows of a text's character n-grams in order, how many lie before each position, and where words start and end.

    A blank stands for either edge of a word, so n-grams have blanks at their ends only; each lies at its first inner character. Case doesn't count.
    """
    chars = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    chars[blank] = 32
    first, end = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    blanks = np.concatenate(([0], np.cumsum(blank)))
    table = np.full((len(chars), len(GRAMS)), -1, np.int32)
    h, n = np.zeros(len(chars), np.uint64), 0
    for k, g in enumerate(GRAMS):
        m = len(chars) - g + 1
        if m <= 0:
            break
        while n < g:
            h, n = (h[:len(chars) - n] ^ chars[n:]) * PRIME, n + 1
            h ^= h >> np.uint64(32)
        inner = blanks[g - 1:g - 1 + m] == blanks[1:1 + m]
        table[1:1 + m, k] = np.where(inner, (h * PRIME >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), -1)
    there = table >= 0
    return table[there], np.concatenate(([0], np.cumsum(there.sum(1)))), first, end


def edges(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the spans of a text of ``n`` words; the last span ends with the text."""
    ends = np.minimum(np.arange(0, max(1, n - SPAN + STEP), STEP) + SPAN, n)
    return np.maximum(ends - SPAN, 0), ends


def fold(id_: Column) -> Column:
    """crc32 of the id's text, mod 3."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 3


class Model:
    """``weight``: what each subword adds to the toxic class's log-odds, once the vectors have met the softmax; ``scale`` and ``shift`` put a
    text's highest span on the scale of probabilities."""

    def __init__(self, weight: np.ndarray, bias: float, scale: float, shift: float):
        self.weight, self.bias, self.scale, self.shift = weight, bias, scale, shift

    def peak(self, text: str) -> float:
        """Log-odds of the text's most toxic span; the bias alone for a text without words."""
        rows, at, first, end = grams(text)
        if not len(first):
            return self.bias
        total = np.concatenate(([0.0], np.cumsum(self.weight[rows], dtype=np.float64)))
        starts, ends = edges(len(first))
        a, b = at[first[starts]], at[end[ends - 1]]
        return float(((total[b] - total[a]) / (b - a)).max()) + self.bias

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * self.peak(text) + self.shift, -30, 30))))


def fit(texts: list[str], toxic: np.ndarray, seed: int = 5) -> Model:
    """Vectors and softmax trained jointly by AdaGrad. A text is as toxic as its most toxic span, so that is what learns; in
    the first epochs all of its spans do, until there is something to tell them apart."""
    rng = np.random.default_rng(seed)
    docs = []
    for t in texts:
        rows, at, first, end = grams(t)
        starts, ends = edges(len(first)) if len(first) else (np.zeros(0, np.int64),) * 2
        docs.append((rows, at[first[starts]], at[end[ends - 1]]))
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    out, bias = rng.uniform(-0.5, 0.5, (DIMENSIONS, 2)), np.zeros(2)
    past = [np.full(BUCKETS, 1e-3), np.full(out.shape, 1e-3), np.full(2, 1e-3)]
    usable = np.array([i for i, d in enumerate(docs) if len(d[0])], np.int64)
    if not len(usable):
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 1.0, -2.0)
    for epoch in range(EPOCHS):
        order = rng.permutation(usable)
        for at in range(0, len(order), BATCH):
            effect = table @ (out[:, 1] - out[:, 0])
            rows, label = [], []
            for i in order[at:at + BATCH]:
                flat, a, b = docs[i]
                if epoch < WARM:
                    pick = rng.choice(len(a), min(len(a), 16), replace=False)
                else:
                    total = np.concatenate(([0.0], np.cumsum(effect[flat])))
                    pick = [int(np.argmax((total[b] - total[a]) / (b - a)))]
                    pick += [] if toxic[i] else [int(rng.integers(len(a)))]
                rows += [flat[a[k]:b[k]] for k in pick]
                label += [int(toxic[i])] * len(pick)
            n = np.array([len(r) for r in rows])
            every, y = np.concatenate(rows), np.array(label)
            mean = np.add.reduceat(table[every], np.concatenate(([0], np.cumsum(n)[:-1]))) / n[:, None]
            logits = mean @ out + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True)
            error[np.arange(len(y)), y] -= 1
            weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
            error *= weight[:, None] * len(y) / 8
            steps = (np.repeat((error @ out.T) / n[:, None], n, axis=0), mean.T @ error, error.sum(0))
            touched, where = np.unique(every, return_inverse=True)
            slope = np.stack([np.bincount(where, steps[0][:, k], len(touched)) for k in range(DIMENSIONS)], 1)
            past[0][touched] += (slope ** 2).mean(1)
            table[touched] -= 0.3 * slope / np.sqrt(past[0][touched])[:, None]
            past[1] += steps[1] ** 2
            out -= 0.1 * steps[1] / np.sqrt(past[1])
            past[2] += steps[2] ** 2
            bias -= 0.1 * steps[2] / np.sqrt(past[2])
    model = Model((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0)
    peaks = np.array([model.peak(t) for t in texts])
    centre, spread = float(np.median(peaks)), float(peaks.std()) or 1.0
    x, a, b = (peaks - centre) / spread, 1.0, 0.0
    share = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum()))
    for _ in range(2000):       # logistic regression of the label on the peak, classes weighing the same
        gap = (1 / (1 + np.exp(-np.clip(a * x + b, -30, 30))) - toxic) * share
        a, b = a - 2.0 * ((gap * x).sum() + 1e-3 * a), b - 2.0 * gap.sum()
    return Model(model.weight, model.bias, a / spread, b - a * centre / spread)


def learned(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> Model:
    """The model fitted on at most ``sample`` texts of each class and ``SAMPLE_BYTES`` in all, from the folds to learn from, in hash order.

    Ids are chosen before texts are read. Of the rows of one id the least text is taken; texts beyond the bytes are left out of the fit.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & (fold(F.col(id_col)) != 1)).select(F.col(id_col).alias("i"), F.col(label_col).alias("y")).distinct()
    chosen = [usable.where(F.col("y") == y).orderBy(F.xxhash64("i"), "i").limit(sample) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    texts = df.select(df[id_col].alias("id"), text_of(df, text_col).alias("text")).join(F.broadcast(ids), F.col("id") == F.col("i"))
    texts = texts.groupBy("id", "y").agg(F.min("text").alias("text"))
    so_far = F.sum(F.octet_length("text")).over(Window.orderBy(F.xxhash64("id"), "id", "y"))        # over at most 2 * sample rows
    rows = texts.withColumn("bytes", so_far).where(F.col("bytes") <= SAMPLE_BYTES).select("id", "text", "y").collect()
    rows.sort(key=lambda r: (r.id, r.y, r.text))
    toxic = np.array([r.y for r in rows])
    if len(set(toxic.tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 1.0, -2.0)
    return fit([r.text for r in rows], toxic)


def scored(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE,
           threshold: float = 0.7) -> DataFrame:
    """(``id_col``, held_out, score, predicted) for every row.

    Labels come from the folds to learn from only; a score depends on the text alone. Its words are read in overlapping spans, whole text
    through, each the mean of its subwords' vectors under one linear softmax; the highest span decides. A misspelling
    shares n-gram vectors with the word it is made from. The model is fitted on at most ``2 * sample`` texts and ``SAMPLE_BYTES``, and is sent to the tasks
    as a table of fixed size; scoring has no shuffle.

    NULL and empty texts get the score of no evidence. Without labels of both classes all texts get one low score. Repeated rows get equal
    scores; labels for ids that aren't there, of other values or NULL, are ignored. Extra columns are not looked at. An empty table gives an empty result.
    """
    model = learned(df, labels, id_col, text_col, label_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.fromiter((model.score(x.as_py()) for x in batch.column(2)), np.float64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             names=["id", "held_out", "score", "predicted"])

    source = df.select(df[id_col].alias("id"), (fold(df[id_col]) == 1).alias("held_out"), text_of(df, text_col).alias("text"))
    out = source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
