"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact check.

Windows as long as an item slide over every text. Each gets a 64-bit SimHash of its shingles, where the second, third,
... place of a shingle counts as a member of its own, so that distance follows the weighted similarity also where one
shingle fills much of a window. The fingerprints are cut into BLOCKS; two within RADIUS bits agree in at least one block up to
RADIUS // BLOCKS bits, so an index of the items' blocks with that many bits flipped finds all of them. What
is found is held against the item exactly: sum of least weights over sum of largest weights.

Before that, a window is fingerprinted only if it holds as many shingles of items of its own size as the threshold
demands of it; that count never rules out a window that the exact check would keep. Items are taken in
blocks of ITEM_WORDS words, so what tasks hold of the benchmark is bounded whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import words as W
from tallyforge.llm.tables import join_texts, plain_ids, row_keyed, save, unique_ids

ITEM_WORDS = 1_000_000
#: Shingles of windows that are fingerprinted at a time.
WINDOW_GRAMS = 200_000
RADIUS = 27
WIDTHS = (10, 9, 9, 9, 9, 9, 9)
BLOCKS = [(sum(WIDTHS[:i]), width) for i, width in enumerate(WIDTHS)]


def _grams(words: W.Words, size: int) -> np.ndarray:
    """Hash of the shingle at each word; 0 where it would leave the document."""
    out = np.zeros(len(words.hash), np.uint64)
    start, hashed = W.windows(words, size)
    out[start] = hashed
    return out


def _members(grams: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of each window as a sorted set in which the second, third, ... place of one are members of their own.

    The sets lie end to end; the places where each ends and the windows' fingerprints come with them. No window is empty.
    """
    width = end - start
    ends = np.concatenate([[0], np.cumsum(width)])
    if not len(width):
        return np.zeros(0, np.uint64), ends, np.zeros(0, np.uint64)
    owner, place = np.repeat(np.arange(len(width)), width), np.arange(ends[-1])
    values = grams[np.repeat(start - ends[:-1], width) + place]
    values = values[np.lexsort((values, owner))]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    turn = place - np.maximum.accumulate(np.where(new, place, 0))
    values = np.where(turn > 0, W.mix(values + turn.astype(np.uint64), 5), values)
    ones = np.add.reduceat(np.unpackbits(values.view(np.uint8)).reshape(-1, 64), ends[:-1], axis=0, dtype=np.int64)
    return values, ends, np.packbits(2 * ones > width[:, None], axis=1).view(np.uint64).reshape(-1)


def _items(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            words = W.split_words(part["text"], lower=True)
            some = np.flatnonzero(words.counts())
            n = words.counts()[some]
            length = np.minimum(n, size)
            width = n - length + 1
            begin = np.concatenate([[0], np.cumsum(width)])
            start = np.repeat(words.first[some] - begin[:-1], width) + np.arange(begin[-1])
            members, ends, fps = _members(W.spans_hash(words.hash, start, start + np.repeat(length, width)), begin[:-1], begin[1:])
            yield pa.RecordBatch.from_pydict({"item_id": part["doc_id"].take(pa.array(some)), "size": pa.array(n, pa.int64()), "fp": W.signed(fps), "grams": W.lists(members, ends)})

    return run


def _spans(at: np.ndarray, words: W.Words, s: int, k: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the windows for items of ``s`` words that hold enough of the shingles at ``at``.

    A full window holds enough if it reaches from one of these places to the one that completes the number; so only
    the places are looked at, not every word. A document that is shorter than the item is one window.
    """
    width, n = s - k + 1, words.counts()
    doc = np.searchsorted(words.first, at, "right") - 1
    need = max(1, -(-percent * 2 * width // (100 + percent)))
    a, b = at[: max(len(at) - need + 1, 0)], at[need - 1 :]
    near = np.flatnonzero((b - a < width) & (doc[need - 1 :] == doc[: len(a)]) & (n[doc[: len(a)]] >= s))
    a, b, own = a[near], b[near], doc[near]
    low, high = np.maximum(b - width + 1, words.first[own]), np.minimum(a, words.first[own + 1] - s)
    low[1:] = np.maximum(low[1:], high[:-1] + 1)
    count = np.maximum(high - low + 1, 0)
    start = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
    short, held = np.unique(doc[n[doc] < s], return_counts=True)
    short = short[(100 + percent) * held >= percent * (n[short] - k + 1 + width)]
    return np.concatenate([start, words.first[short]]), np.concatenate([start + width, words.first[short + 1] - k + 1])


def _candidates(known: np.ndarray, sizes: np.ndarray, size: int, percent: int):
    """Windows with enough shingles of items of their size: (doc_id, start, size, window, fp, grams); grams once per chunk.

    ``known`` are the items' shingles, ``sizes`` the sizes of the items that have them.
    """
    lengths = []
    for k in sorted({min(int(s), size) for s in sizes}):
        own = np.minimum(sizes, size) == k
        values, index = np.unique(known[own], return_inverse=True)
        lengths.append((k, values, {int(s): index[sizes[own] == s] for s in np.unique(sizes[own])}))

    def low(grams: np.ndarray, seen: np.ndarray) -> np.ndarray:
        return (grams & np.uint64(len(seen) - 1)).view(np.int64)

    def of_length(part: pa.RecordBatch, words: W.Words, k: int, values: np.ndarray, own: dict[int, np.ndarray], seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        grams = _grams(words, k)
        at = np.flatnonzero(seen[low(grams, seen)])
        index = np.minimum(np.searchsorted(values, grams[at]), len(values) - 1)
        hit = values[index] == grams[at]
        at, index = at[hit], index[hit]
        if not len(at):
            return
        spans, wanted = [], np.zeros(len(values), bool)
        for s, of_size in own.items():
            wanted[of_size] = True
            places = at[wanted[index]]
            wanted[of_size] = False
            if len(places):
                start, end = _spans(places, words, s, k, percent)
                spans.append((start, end, np.full(len(start), s)))
        start, end, s = (np.concatenate(x) for x in zip(*spans, strict=True))
        window = W.mix(W.spans_hash(words.hash, start, end + k - 1) + s.astype(np.uint64))
        first = np.zeros(len(start), bool)
        first[np.unique(window, return_index=True)[1]] = True
        shown = np.concatenate([[0], np.cumsum(np.where(first, end - start, 0))])
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(shown[1:] // WINDOW_GRAMS)) + 1, [len(start)]]))
        doc = np.searchsorted(words.first, start, "right") - 1
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            new = first[i:j]
            members, _, fps = _members(grams, start[i:j][new], end[i:j][new])
            fp = np.zeros(j - i, np.uint64)
            fp[new] = fps
            lists = pa.ListArray.from_arrays(pa.array(shown[i : j + 1] - shown[i], pa.int32()), W.signed(members), mask=pa.array(~new))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": part["doc_id"].take(pa.array(doc[i:j])), "start": pa.array(start[i:j] - words.first[doc[i:j]], pa.int64()), "size": pa.array(s[i:j], pa.int64())}
                | {"window": W.signed(window[i:j]), "fp": W.signed(fp), "grams": lists}
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for _, values, _ in lengths:
            # by their low bits most words are ruled out before they are looked up
            seen = np.zeros(1 << min(24, max(16, (16 * len(values)).bit_length())), bool)
            seen[low(values, seen)] = True
            tables.append(seen)
        for part in W.chunks(batches, "text"):
            words = W.split_words(part["text"], lower=True)
            for (k, values, own), seen in zip(lengths, tables, strict=True):
                yield from of_length(part, words, k, values, own, seen)

    return run


def _block(fp: str, shift: int, width: int) -> F.Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(window, item_id) of equal size whose fingerprints differ in at most RADIUS bits."""
    flips = {w: [sum(1 << i for i in c) for r in range(RADIUS // len(BLOCKS) + 1) for c in combinations(range(w), r)] for w in set(WIDTHS)}

    def near(i: int, shift: int, width: int) -> F.Column:
        flip = F.array(*(F.lit(m).cast("long") for m in flips[width]))
        return F.transform(flip, lambda m: F.struct(F.lit(i).alias("block"), _block("fp", shift, width).bitwiseXOR(m).alias("value")))

    around = F.concat(*(near(i, shift, width) for i, (shift, width) in enumerate(BLOCKS)))
    index = items.select("item_id", "size", F.col("fp").alias("item_fp"), F.explode(around).alias("at")).select("item_id", "size", "item_fp", "at.*")
    own = F.array(*[F.struct(F.lit(i).alias("block"), _block("fp", s, w).alias("value")) for i, (s, w) in enumerate(BLOCKS)])
    asked = windows.select("window", "size", "fp", F.explode(own).alias("at")).select("window", "size", "fp", "at.*")
    met = asked.join(index, ["size", "block", "value"])
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS).select("window", "item_id").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_windows) of every document that holds a passage like an item.

    A-Z count as a-z. A passage is a window of as many words as the item (the whole text where that is
    shorter) whose weighted shingle similarity is at least ``percent`` / 100; the best one's similarity and
    first place (words from 0) are given, and how many windows pass. Items of fewer than ``size`` words are one shingle.
    Null and word-free texts or items have no windows. Every row and item is judged by its own text, also where ids are null or
    repeated, so one pair of ids may then come more than once. At 75 percent two fingerprints differ in about 11 bits on average, with a deviation of
about 3, repeated shingles or not: the places of a shingle are members of their own.
    """
    if not plain_ids(docs, id_col):
        rows, once = row_keyed(docs, id_col, text_col)
        found = save(leaks(once, benchmark, item_col=item_col, size=size, percent=percent).withColumnRenamed("doc_id", "_row"))
        ids = rows.select("_row", F.col(id_col).cast("long").alias("doc_id")).distinct()
        return ids.join(found, "_row").select("doc_id", *[c for c in found.columns if c != "_row"])
    if not plain_ids(benchmark, item_col):
        rows, once = row_keyed(benchmark, item_col, "text")
        found = save(leaks(docs, once, id_col, text_col, "doc_id", size, percent).withColumnRenamed("item_id", "_row"))
        ids = rows.select("_row", F.col(item_col).cast("long").alias("item_id")).distinct()
        return ids.join(found, "_row").select("doc_id", "item_id", "similarity", "start", "n_windows")
    docs = unique_ids(docs, id_col, text_col)
    items = save(unique_ids(benchmark, item_col, "text").mapInArrow(_items(size), "item_id bigint, size bigint, fp bigint, grams array<bigint>").where("size > 0"))
    blocks = max(1, -(-(items.agg(F.sum("size")).first()[0] or 0) // ITEM_WORDS))
    found = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        known = np.array(own.select(F.explode("grams"), "size").distinct().collect(), np.int64).reshape(-1, 2)
        if not len(known):
            continue
        schema = "doc_id bigint, start bigint, size bigint, window bigint, fp bigint, grams array<bigint>"
        hits = save(docs.mapInArrow(_candidates(known[:, 0].copy().view(np.uint64), known[:, 1].copy(), size, percent), schema))
        windows = save(hits.where("grams IS NOT NULL").dropDuplicates(["window"]).select("window", "size", "fp", "grams"))
        pairs = _within_radius(windows, own).join(windows.select("window", "grams"), "window")
        pairs = pairs.join(own.select("item_id", F.col("grams").alias("item_grams")), "item_id").withColumn("same", F.size(F.array_intersect("grams", "item_grams")))
        either = F.size("grams") + F.size("item_grams") - F.col("same")
        pairs = pairs.where(100 * F.col("same") >= percent * either).select("window", "item_id", (F.col("same") / either).alias("similarity"))
        found.append(hits.select("doc_id", "start", "window").join(pairs, "window"))
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, similarity double, start bigint, n_windows bigint")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    rows = reduce(DataFrame.union, found).groupBy("doc_id", "item_id").agg(best, F.count("*").alias("n_windows"))
    return rows.select("doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start"), "n_windows")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no passage of the benchmark; columns as they came.

    Every row is judged by its own text, also where ids are null or repeated; empty tables lose nothing.
    """
    if not plain_ids(docs, id_col):
        rows, once = row_keyed(docs, id_col, text_col)
        bad = save(leaks(once, benchmark).select(F.col("doc_id").alias("_row")).distinct())
        return rows.join(bad, "_row", "left_anti").select(docs.columns)
    bad = save(leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct())
    return join_texts(docs, bad, id_col, "left_anti").select(docs.columns)
