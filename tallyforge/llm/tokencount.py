"""Token counts that follow edits: a tree of pre-token counts per document.

A leaf holds up to LEAF pre-tokens: how many characters they span and how many tokens they make. Inner nodes hold
the sums of their two children, so the document's count is at the root and a place is found in steps of the tree's
height. An edit re-splits its text from the leaf that holds the character REACH places before it (no pre-token that ends
earlier can see the edit) to the first leaf border after it that is also a border of the new text; from
there on nothing changes. Only pre-tokens in between are encoded again, and only their leaves' ancestors are summed again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyforge.llm.bpe import Codec, codec_of, vocabulary
from tallyforge.llm.words import chunks

LEAF = 16
REACH = 3


class Tree:
    """Characters and tokens of leaves; node i has children 2i and 2i + 1, leaves follow the inner nodes."""

    def __init__(self, chars: Sequence[int], counts: Sequence[int]):
        self.size = 1 << max(len(chars) - 1, 0).bit_length()
        self.chars, self.counts = self._summed(chars), self._summed(counts)

    def _summed(self, leaves: Sequence[int]) -> list[int]:
        nodes = np.zeros(2 * self.size, np.int64)
        nodes[self.size : self.size + len(leaves)] = leaves
        at = self.size
        while at > 1:
            nodes[at // 2 : at] = nodes[at : 2 * at : 2] + nodes[at + 1 : 2 * at : 2]
            at //= 2
        return nodes.tolist()

    @classmethod
    def unpack(cls, raw: bytes) -> Tree:
        tree = cls.__new__(cls)
        nodes = np.frombuffer(raw, "<i4").reshape(2, -1)
        tree.chars, tree.counts = nodes.tolist()
        tree.size = len(tree.chars) // 2
        return tree

    def pack(self) -> bytes:
        return np.array([self.chars, self.counts], "<i4").tobytes()

    @property
    def tokens(self) -> int:
        return self.counts[1]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one for a place at the end), and the leaf's first character."""
        node, begin, chars = 1, 0, self.chars
        while node < self.size:
            node *= 2
            if place >= begin + chars[node] and chars[node + 1]:
                begin += chars[node]
                node += 1
        return node - self.size, begin

    def leaf(self, i: int) -> tuple[int, int]:
        return self.chars[self.size + i], self.counts[self.size + i]

    def replace(self, first: int, last: int, chars: list[int], counts: list[int]) -> None:
        """New leaves for those from first to last; grows the tree if they need more room."""
        room = last - first + 1
        if len(chars) > room:
            own = [self.size + i for i in (*range(first), *range(last + 1, self.size)) if self.chars[self.size + i]]
            before = sum(1 for i in own if i < self.size + first)
            kept = [([x[i] for i in own[:before]], [x[i] for i in own[before:]]) for x in (self.chars, self.counts)]
            self.__init__(kept[0][0] + chars + kept[0][1], kept[1][0] + counts + kept[1][1])
            return
        low, high = self.size + first, self.size + last
        none = [0] * (room - len(chars))
        self.chars[low : high + 1], self.counts[low : high + 1] = chars + none, counts + none
        low, high = low // 2, high // 2
        while low:
            for sums in (self.chars, self.counts):
                for node in range(low, high + 1):
                    sums[node] = sums[2 * node] + sums[2 * node + 1]
            low, high = low // 2, high // 2


def _leaves(pieces: list[str], codec: Codec, room: int = 0) -> tuple[list[int], list[int]]:
    """Characters and tokens of leaves of LEAF pieces; of up to 2 * LEAF, where that makes do with ``room`` leaves."""
    if not pieces:
        return [], []
    wide = -(-len(pieces) // room) if room else LEAF
    begin = range(0, len(pieces), max(wide, LEAF) if wide <= 2 * LEAF else LEAF)
    chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
    tokens = np.fromiter(map(len, map(codec.__getitem__, pieces)), np.int64, len(pieces)) // 4
    return np.add.reduceat(chars, begin).tolist(), np.add.reduceat(tokens, begin).tolist()


def build_tree(text: str, codec: Codec) -> Tree:
    return Tree(*_leaves(codec.pattern.findall(text), codec))


def edit(text: str, tree: Tree, at: int, cut: int, put: str, codec: Codec) -> tuple[str, int]:
    """The text with ``cut`` characters from ``at`` replaced by ``put``, and how many pre-tokens were counted; updates the tree."""
    at = min(max(at, 0), len(text))
    stop = min(at + max(cut, 0), len(text))
    new = text[:at] + put + text[stop:]
    shift = len(new) - len(text)
    first, begin = tree.find(max(at - REACH, 0))
    last, border = first, begin + tree.leaf(first)[0]
    pieces: list[str] = []
    place = begin
    matches = codec.pattern.finditer(new, begin)
    while True:
        while last < tree.size - 1 and (border < stop or border + shift < place):
            last += 1
            border += tree.leaf(last)[0]
        if place == border + shift and border >= stop and place >= at + len(put):
            break
        match = next(matches, None)
        if match is None:
            last = tree.size - 1
            break
        pieces.append(match[0])
        place = match.end()
    tree.replace(first, last, *_leaves(pieces, codec, last - first + 1))
    return new, len(pieces)


def build(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with tree (binary) and n_tokens (replacing columns of these names); null texts have no tokens."""
    shared = vocabulary(docs.sparkSession, path)
    columns = [c for c in docs.columns if c not in ("tree", "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, pattern)
        for part in chunks(batches, text_col):
            trees = [build_tree(text or "", codec) for text in part[text_col].to_pylist()]
            yield pa.RecordBatch.from_pydict({c: part[c] for c in columns} | {"tree": pa.array([t.pack() for t in trees], pa.binary()), "n_tokens": pa.array([t.tokens for t in trees], pa.int64())})

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(columns).mapInArrow(run, f"{kinds}, tree binary, n_tokens bigint")


def apply_edits(rows: DataFrame, path: str, pattern: str, text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """``rows`` with text, tree and n_tokens after their edits, n_before them, and n_recounted (pre-tokens encoded again).

    Rows that bring no ``tree`` column get theirs from their text in the same pass.

    ``edits`` is an array of (at, cut, put): from character ``at``, ``cut`` characters give way to ``put``; in order,
    each on what the one before left. Places beyond the text are moved to its end; a null put is empty, null
    at or cut is 0, a null edit or list changes nothing. Rows are edited each by itself, so repeated ones need no rule.
    """
    shared = vocabulary(rows.sparkSession, path)
    made = {"text": pa.string(), "tree": pa.binary(), "n_tokens": pa.int64(), "n_before": pa.int64(), "n_recounted": pa.int64()}
    columns = [c for c in rows.columns if c not in (text_col, *list(made)[1:])]
    built = "tree" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, pattern)
        for part in chunks(batches, text_col):
            out = {k: [] for k in made}
            trees = part["tree"].to_pylist() if built else [None] * part.num_rows
            for text, raw, edits in zip(part[text_col].to_pylist(), trees, part[edits_col].to_pylist(), strict=True):
                tree, done = build_tree(text or "", codec) if raw is None else Tree.unpack(raw), 0
                before = tree.tokens
                for e in edits or []:
                    if e is not None:
                        text, n = edit(text or "", tree, e["at"] or 0, e["cut"] or 0, e["put"] or "", codec)
                        done += n
                for k, v in (("text", text), ("tree", tree.pack()), ("n_tokens", tree.tokens), ("n_before", before), ("n_recounted", done)):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict({c: part[c] for c in columns} | {(text_col if k == "text" else k): pa.array(v, made[k]) for k, v in out.items()})

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    kinds += (", " if kinds else "") + f"`{text_col}` string, tree binary, n_tokens bigint, n_before bigint, n_recounted bigint"
    return rows.mapInArrow(run, kinds)
