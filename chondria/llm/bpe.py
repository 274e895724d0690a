"""Byte-level BPE by longest matches and backtracking."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from chondria.llm.common import text_of

PIECES = 800_000        # pieces whose tokens a worker remembers (about 200 MB)
NONE = -1
PAIRS = 1_000_000       # pairs of tokens whose compatibility it remembers


class Pieces(dict):
    """Tokens by piece, made when a piece is first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self[piece] = self.make(piece)
        return ids


class Vocabulary:
    """Token bytes and ranks, with what encoding needs. Bytes are mapped to Latin-1, so that one character stands for each."""

    def __init__(self, content: bytes, pattern: str):
        tokens = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, content.splitlines()))
        size = tokens[-1][0] + 1
        self.bytes = dict(tokens)
        self.name = [""] * size
        for rank, token in tokens:
            self.name[rank] = token.decode("latin-1")
        self.rank = {name: rank for rank, name in enumerate(self.name) if name}
        self.text = {rank: str(rank) for rank in self.bytes}
        self.length = list(map(len, self.name))
        self.shorter = [next((self.rank[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.rank), NONE) for t in self.name]
        self.halves = [self.last_merge(t) for t in self.name]
        self.split = regex.compile(pattern)
        self.matches = ahocorasick.Automaton()
        for name, rank in self.rank.items():
            self.matches.add_word(name, (len(name) - 1, rank))
        self.matches.make_automaton()
        self.pieces = Pieces(self.encode_piece)
        self.pairs: dict[int, bool] = {}

    def merged(self, piece: str) -> list[str]:
        """Parts left by merging the pair of lowest rank again and again: the definition, used on single tokens."""
        parts = list(piece)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[best] + parts[best + 1] not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def last_merge(self, token: str) -> tuple[int, int] | None:
        """The two tokens that the last of a token's merges joins: of all cuts in two tokens, the one that lower merges leave."""
        cuts = [(token[:k], token[k:]) for k in range(1, len(token)) if token[:k] in self.rank and token[k:] in self.rank]
        if len(cuts) > 1:
            top = self.rank[token]
            del self.rank[token]
            parts = self.merged(token)
            self.rank[token] = top
            cuts = [tuple(parts)] if len(parts) == 2 else []
        return (self.rank[cuts[0][0]], self.rank[cuts[0][1]]) if cuts else None

    def fits(self, a: int, b: int) -> bool:
        """Whether the merges of two tokens' bytes leave exactly these two.

        Seen backwards in time: the last merge of either token is undone, the later one first. Wherever the parts that then meet could
        have been merged before what was just undone, they would have been.
        """
        name, rank, halves = self.name, self.rank, self.halves
        until = 1 << 40
        while True:
            joined = rank.get(name[a] + name[b])
            if joined is not None and joined < until:
                return False
            # among equal ranks the left merge comes first, so the right token's is the later one
            if halves[a] and (a > b or not halves[b]):
                until, a = a, halves[a][1]
            elif halves[b]:
                until, b = b + 1, halves[b][0]
            else:
                return True

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Tokens of one piece, by backtracking over the longest matches.

        From the left it takes the longest match that fits the token before it, then shorter ones, and steps back when none does. An end
        that was given up once is never tried again, so each position is left at most once.
        """
        s = piece.encode("utf-8").decode("latin-1")
        if s in self.rank and (len(s) == 1 or self.halves[self.rank[s]]):
            return (self.rank[s],)
        n, length, shorter, pairs = len(s), self.length, self.shorter, self.pairs
        longest = [NONE] * (n + 1)
        for end, (back, rank) in self.matches.iter(s):
            longest[end - back] = rank      # of one start, later ends are longer matches
        open_, taken, at, token = [True] * (n + 1), [], 0, longest[0]
        while at < n:
            while token != NONE:
                if open_[at + length[token]]:
                    if taken:
                        key = taken[-1] << 32 | token
                        fit = pairs.get(key)
                        if fit is None:
                            if len(pairs) >= PAIRS:
                                pairs.clear()
                            fit = pairs[key] = self.fits(taken[-1], token)
                    else:
                        fit = length[token] == 1 or self.halves[token] is not None
                    if fit:
                        break
                token = shorter[token]
            if token == NONE:
                open_[at] = False
                token = taken.pop()
                at -= length[token]
                token = shorter[token]
            else:
                taken.append(token)
                at += length[token]
                token = longest[at]
        return tuple(taken)

    def encode(self, text: str) -> list[int]:
        """Tokens of a whole text, each match of the pattern on its own."""
        if len(self.pieces) > PIECES:
            for old in list(islice(self.pieces, PIECES // 2)):
                del self.pieces[old]
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split.findall(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(content: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(content, pattern)


def encoded(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids): the token ids of every whole text, as an array. NULL is encoded as the empty text, to no ids."""
    content = open(ranks, "rb").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(content, pattern)
        for batch in batches:
            ids = pa.array([v.encode(x.as_py()) for x in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    source = df.select(df[id_col].alias("id"), text_of(df, text_col).alias("text"))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, ids array<int>").withColumnRenamed("id", id_col)


def decoded(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``id_col``, decoded): the bytes that token ids stand for. A NULL array decodes to no bytes."""
    content = open(ranks, "rb").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(content, pattern)
        for batch in batches:
            texts = pa.array([v.decode(x.as_py() or []) for x in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["id", "decoded"])

    source = df.select(df[id_col].alias("id"), df[ids_col].cast("array<int>").alias("ids"))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, decoded binary").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, then decoded from the ids, in one pass.

    Each text is encoded on its own, so there is no shuffle. Memory is bounded: a text, its ids, and two caches of fixed size.
    NULL counts as empty: no ids, and the digests of nothing. Repeated rows give repeated results; extra columns are not looked at;
    an empty table gives an empty result. The vocabulary file is read by the driver and sent along; its size doesn't depend on the data.
    """
    content = open(ranks, "rb").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(content, pattern)
        for batch in batches:
            rows = []
            for x in batch.column(1):
                ids = v.encode(x.as_py())
                rows.append((len(ids), hashlib.sha256(" ".join(map(v.text.__getitem__, ids)).encode()).hexdigest(),
                             hashlib.sha256(v.decode(ids)).hexdigest()))
            n, a, b = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = df.select(df[id_col].alias("id"), text_of(df, text_col).alias("text"))
    out = source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
