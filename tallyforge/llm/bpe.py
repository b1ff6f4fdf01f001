"""Byte-level BPE in linear time, and its inverse.

The vocabulary's byte strings, read as Latin-1, form an Aho-Corasick trie that tells how far tokens can reach
from any place of a piece. A sequence of tokens is what the merges would give exactly if each two
neighbours are what the merges give for their joined bytes; that is worked out once per pair and kept. Encoding tries
the longest token first and steps back where no token fits its left neighbour. The tokens before a place are
the same whichever way it is reached, so a place that failed is never tried again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.words import chunks

KEPT_PIECES = 250_000
KEPT_PAIRS = 200_000


class Codec(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers, worked out on first use.

    Pieces and pairs are kept for two generations: when the young one has grown to its share, it becomes the old one, and what was
    the old one and has not been asked for since is dropped. That costs time, not correctness.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes = {i: b for b, i in ranks.items()}
        self.trie = ahocorasick.Automaton()
        self.longest = max(map(len, ranks), default=0)
        self.above = max(self.bytes, default=0) + 1
        # of every beginning of a token, the longest token it begins with; of every token, the next shorter one (-1: none)
        self.best: dict[str, int] = {}
        self.size, self.shorter = [0] * self.above, [-1] * self.above
        for raw in sorted(ranks):
            text, token = raw.decode("latin-1"), ranks[raw]
            self.trie.add_word(text, token)
            self.size[token] = len(text)
            known = len(text) - 1
            while known > 0 and text[:known] not in self.best:
                known -= 1
            shorter = self.best[text[:known]] if known > 0 else -1
            self.shorter[token] = shorter
            for k in range(known + 1, len(text)):
                self.best[text[:k]] = shorter
            self.best[text] = token
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.unordered: set[int] = set()
        self.old: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}  # by left * 2^32 + right
        self.old_pairs: dict[int, bool] = {}

    def merged(self, raw: bytes, but: int = -1) -> list[int]:
        """The merges by definition: lowest rank first, leftmost first, never to the token ``but``. For the few bytes of a token."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            made = [self.ranks.get(parts[i] + parts[i + 1], self.above) for i in range(len(parts) - 1)]
            rank = min(self.above if r == but else r for r in made)
            if rank == self.above:
                break
            i = made.index(rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of ``token`` joins; itself twice where no merges make it, None for a single byte."""
        if token not in self.halves:
            raw = self.bytes[token]
            parts = self.merged(raw, token) if len(raw) > 1 else None
            two = None if parts is None else (parts[0], parts[1]) if len(parts) == 2 else (token, token)
            self.halves[token] = two
            if two and two[0] != token:
                for part in two:
                    self.split(part)
                if max(two) > token or not self.unordered.isdisjoint(two):
                    self.unordered.add(token)
        return self.halves[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges leave these two neighbours as they are.

        Merges are undone from the last one backwards. Each time the tokens now at the border must not have a merge of their own that
        would have come before the one just undone; of equal ranks the left one comes first. Tokens made by merges of falling ranks,
        which a trained vocabulary has none of, are decided by the merges themselves.
        """
        self.split(left), self.split(right)
        if self.unordered and not self.unordered.isdisjoint((left, right)):
            return self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
        ranks, text, before = self.ranks, self.bytes, self.above
        while True:
            if ranks.get(text[left] + text[right], self.above) < before:
                return False
            one, two = self.split(left), self.split(right)
            if one is None and two is None:
                return True
            if one is not None and (two is None or left > right):
                if one[0] == left:
                    return False
                before, left = left, one[1]
            else:
                if two[0] == right:
                    return False
                before, right = right + 1, two[0]

    def fits(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            known = self.old_pairs.get(pair)
            if known is None:
                known = self.apart(left, right)
            if len(self.pairs) >= KEPT_PAIRS // 2:
                self.old_pairs = self.pairs.copy()
                self.pairs.clear()
            self.pairs[pair] = known
        return known

    def ids(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        text, n = piece.decode("latin-1"), len(piece)
        reach, longest, best, size, shorter, pairs = self.trie.longest_prefix, self.longest, self.best, self.size, self.shorter, self.pairs
        failed = bytearray(n + 1)
        out: list[int] = []
        place, left, fresh, token = 0, -1, True, -1
        while place < n:
            if fresh:
                ahead = text[place : place + longest]
                token = best.get(ahead[: reach(ahead)], -1)
            while token >= 0:
                if not failed[place + size[token]]:
                    if left < 0:
                        break
                    fits = pairs.get(left << 32 | token)
                    if fits or (fits is None and self.fits(left, token)):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                place, left, fresh = place + size[token], token, True
            else:
                failed[place] = 1
                if not out:
                    raise ValueError(f"the vocabulary has no tokens for {piece[:80]!r}")
                token = out.pop()
                place, left, token, fresh = place - size[token], out[-1] if out else -1, shorter[token], False
        return out

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            ids = self.ids(piece.encode())
            packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self) >= KEPT_PIECES // 2:
                self.old = self.copy()
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))


def decode_ids(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


@lru_cache(maxsize=2)
def codec_of(raw: bytes, pattern: str) -> Codec:
    return Codec(read_ranks(raw), pattern)


@lru_cache(maxsize=2)
def tokens_of(raw: bytes) -> dict[int, bytes]:
    return {i: b for b, i in read_ranks(raw).items()}


def vocabulary(spark: SparkSession, path: str) -> Broadcast[bytes]:
    """The vocabulary file (about 1 MB), read where the query is built."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with tokens (binary: ids as little-endian unsigned 32-bit integers) and n_tokens.

    Each match of ``pattern`` is encoded by itself, without special tokens. Null and empty texts have no
    tokens. Every row is encoded by itself, so repeated rows and null ids need no rule; columns named tokens or n_tokens
    are replaced. With ``decoded`` the ids are decoded in the same pass, as ``decode`` does, into a column of that name.
    """
    shared = vocabulary(docs.sparkSession, path)
    made = {"tokens": "binary", "n_tokens": "bigint"} | ({"decoded": "binary"} if decoded else {})
    columns = [c for c in docs.columns if c not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, pattern)
        for part in chunks(batches, text_col):
            packed = [codec.encode(text) if text else b"" for text in part[text_col].to_pylist()]
            out = {"tokens": pa.array(packed, pa.binary()), "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64())}
            if decoded:
                out["decoded"] = pa.array([decode_ids(ids, codec.bytes) for ids in packed], pa.binary())
            yield pa.RecordBatch.from_pydict({c: part[c] for c in columns} | out)

    kinds = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns] + [f"{c} {kind}" for c, kind in made.items()])
    wanted = columns if text_col in columns else [*columns, text_col]
    return docs.select(wanted).mapInArrow(run, kinds)


def decode(rows: DataFrame, path: str, tokens_col: str = "tokens") -> DataFrame:
    """``rows`` with decoded (binary): the bytes of the packed ids; null ids give no bytes, unknown ones an error."""
    shared = vocabulary(rows.sparkSession, path)
    columns = [c for c in rows.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(shared.value)
        for part in chunks(batches, tokens_col):
            raw = [decode_ids(ids, tokens) if ids else b"" for ids in part[tokens_col].to_pylist()]
            yield pa.RecordBatch.from_pydict({c: part[c] for c in columns} | {"decoded": pa.array(raw, pa.binary())})

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.select(columns).mapInArrow(run, f"{kinds}, decoded binary")
