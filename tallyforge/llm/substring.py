"""Removal of long passages that occur more than once, by a compacted graph of token k-mers.

Of all k-mers (KMER words) only those matter that are the least of some window of ``length`` words, by
hash: equal windows choose the same k-mer at the same place, so a window can repeat only if its k-mer does.
A k-mer is an edge of the graph; its context, the words that windows around it can reach, tells how paths run
through it. A repeated k-mer with one context is nonbranching: every window it stands for repeats. Runs of
them in a document are compacted into one span of a path, by their ordinals. Where paths branch or end, the
few windows of each distinct context are compared by their own hashes, weighted by the context's count,
so every span is verified on its source coordinates and none is missed.

Documents with equal word sequences are taken once; all their words go if they hold a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import words as W
from tallyforge.llm.tables import join_texts, plain_ids, row_keyed, save, unique_ids

KMER = 12
LENGTH = 35


def _digests(words: W.Words) -> dict[str, pa.Array]:
    first, last = words.first[:-1], words.first[1:]
    return {"n": pa.array(last - first, pa.int64()), "d1": W.signed(W.spans_hash(words.hash, first, last)), "d2": W.signed(W.spans_hash(words.hash, first, last, "other"))}


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in W.chunks(batches, "text"):
        yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"]} | _digests(W.split_words(part["text"])))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """For every start the place of the leftmost least key among ``width``."""
    view = np.lib.stride_tricks.sliding_window_view(keys, width)
    return np.arange(len(view)) + np.argmin(view, axis=1)


class _Anchors:
    """The least k-mers of the windows of some documents, and the windows that each stands for."""

    def __init__(self, words: W.Words, length: int):
        first, last = words.first[:-1], words.first[1:]
        starts = W.windows(words, length)[0]
        kmers = np.zeros(len(words.hash), np.uint64)
        places, hashed = W.windows(words, KMER)
        kmers[places] = hashed
        self.kmers, self.words = kmers, words
        owner = words.owner()[starts] if len(starts) else starts
        chosen = _least(W.mix(kmers, 7), length - KMER + 1)[starts] if len(starts) else starts
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(chosen) != 0) | (np.diff(owner) != 0)
        begin = np.flatnonzero(new)
        self.starts, self.begin = starts, np.append(begin, len(starts))
        self.place, self.doc = chosen[begin], owner[begin]
        self.low = starts[begin]
        self.high = starts[self.begin[1:] - 1] if len(begin) else starts
        reach = length - KMER
        self.left = np.maximum(first[self.doc], self.place - reach)
        self.right = np.minimum(last[self.doc], self.place + KMER + reach)
        shape = ((self.place - self.left) * 1024 + self.right - self.place).astype(np.uint64)
        self.context = W.mix(W.spans_hash(words.hash, self.left, self.right) + shape * np.uint64(0x9E3779B97F4A7C15))
        ordinal = np.arange(len(begin))
        change = np.ones(len(begin), bool)
        change[1:] = np.diff(self.doc) != 0
        self.ordinal = ordinal - np.maximum.accumulate(np.where(change, ordinal, 0)) if len(begin) else ordinal


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            words = W.split_words(part["text"])
            a = _Anchors(words, length)
            base = words.first[a.doc]
            yield pa.RecordBatch.from_pydict(
                {"kmer": W.signed(a.kmers[a.place]), "context": W.signed(a.context), "doc_id": part["doc_id"].take(pa.array(a.doc))}
                | {k: pa.array(v.astype(np.int32)) for k, v in (("i", a.ordinal), ("place", a.place - base), ("low", a.low - base), ("high", a.high - base))}
            )

    return run


def _windows(length: int):
    """Hashes of all windows that the named anchors stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            words = W.split_words(part["text"])
            a = _Anchors(words, length)
            named = part["places"]
            wanted = np.concatenate([named.flatten().to_numpy() + np.repeat(words.first[:-1], named.value_lengths().to_numpy()), np.zeros(0, np.int64)]).astype(np.int64)
            pick = np.flatnonzero(np.isin(a.place, wanted))
            size = a.begin[pick + 1] - a.begin[pick]
            rows = np.repeat(a.begin[pick] - np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64), size) + np.arange(size.sum()) if len(pick) else pick
            start, anchor = a.starts[rows], np.repeat(pick, size)
            yield pa.RecordBatch.from_pydict(
                {
                    "kmer": W.signed(a.kmers[a.place[anchor]]),
                    "context": W.signed(a.context[anchor]),
                    "off": pa.array((a.place[anchor] - start).astype(np.int32)),
                    "window": W.signed(W.spans_hash(words.hash, start, start + length)),
                }
            )

    return run


def _cut(columns: list[str], text: str):
    """Words in spans removed; the other columns as they came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, text):
            words = W.split_words(part[text])
            digest = _digests(words)["d1"].to_pylist()
            removed, kept = [], []
            for i, (raw, spans, known) in enumerate(zip(part[text].to_pylist(), part["_spans"].to_pylist(), part["_d1"].to_pylist(), strict=True)):
                pieces = (raw or "").encode().split()
                gone = 0
                if spans and known == digest[i]:
                    change = np.zeros(len(pieces) + 1, np.int32)
                    ends = np.array([(s["from"], s["to"]) for s in spans])
                    np.add.at(change, ends[:, 0], 1)
                    np.add.at(change, ends[:, 1], -1)
                    stay = np.cumsum(change[:-1]) == 0
                    gone = len(pieces) - int(stay.sum())
                    pieces = compress(pieces, stay.tolist())
                removed.append(gone)
                kept.append(b" ".join(pieces).decode())
            yield pa.RecordBatch.from_pydict(
                {c: part[c] for c in columns}
                | {"_n_words": pa.array(words.counts(), pa.int64()), "_n_removed": pa.array(removed, pa.int64()), "_kept": pa.array(kept, pa.string())}
            )

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, d1, path, from, to): spans of words that are covered by repeated windows.

    ``path`` names the compacted path (its first k-mer), or is null for single verified windows and whole copies.
    """
    numbers = save(docs.mapInArrow(_sequences, "doc_id bigint, n bigint, d1 bigint, d2 bigint")).where(F.col("n") >= length)
    classes = numbers.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"))
    members = save(numbers.join(classes, ["n", "d1", "d2"]).select("doc_id", "n", "d1", "rep", "c"))
    short = join_texts(docs, members.where("doc_id <> rep").select("doc_id"), "doc_id", "left_anti")
    anchors = save(short.mapInArrow(_anchors(length), "kmer bigint, context bigint, doc_id bigint, i int, place int, low int, high int"))
    again = save(anchors.groupBy("kmer").agg(F.count("*").alias("c")).where("c > 1").select("kmer"))  # written, so hot k-mers of the join can be split
    found = save(anchors.join(again, "kmer"))

    contexts = found.groupBy("kmer", "context").agg(F.count("*").alias("weight"), F.min(F.struct("doc_id", "place")).alias("at"))
    shapes = found.groupBy("kmer").agg((F.min("context") < F.max("context")).alias("branching"))
    contexts = save(contexts.join(shapes, "kmer").where("branching"))
    places = save(contexts.groupBy("at.doc_id").agg(F.collect_list("at.place").alias("places")))
    named = join_texts(docs, places, "doc_id", row_bytes="40 + 4 * size(places)")
    seen = save(named.mapInArrow(_windows(length), "kmer bigint, context bigint, off int, window bigint").distinct().join(contexts.select("kmer", "context", "weight"), ["kmer", "context"]))
    twice = seen.groupBy("kmer", "off", "window").agg(F.sum("weight").alias("w")).where("w > 1").drop("w")
    checked = seen.join(twice, ["kmer", "off", "window"]).groupBy("kmer", "context").agg(F.collect_set("off").alias("offs"))
    most, least = F.array_max("offs"), F.array_min("offs")  # of one k-mer, so no more than a window has places
    whole = F.when(most - least + 1 == F.size("offs"), F.array(F.struct(most.alias("most"), least.alias("least"))))
    runs = F.coalesce(whole, F.transform("offs", lambda o: F.struct(o.alias("most"), o.alias("least"))))
    windows = found.join(checked.select("kmer", "context", F.explode(runs).alias("run")), ["kmer", "context"])
    windows = windows.select("doc_id", F.lit(None).cast("long").alias("path"), (F.col("place") - F.col("run.most")).alias("from"), (F.col("place") - F.col("run.least") + length).alias("to"))

    plain = found.join(shapes.where("NOT branching"), "kmer")
    run = F.col("i") - F.row_number().over(Window.partitionBy("doc_id").orderBy("i"))
    paths = plain.withColumn("run", run).groupBy("doc_id", "run").agg(F.min_by("kmer", "i").alias("path"), F.min("low").alias("from"), (F.max("high") + length).alias("to"))
    spans = paths.select("doc_id", "path", "from", "to").union(windows).join(members.where("c = 1").select("doc_id", "d1"), "doc_id")
    whole = members.where("c > 1").select("doc_id", F.lit(None).cast("long").alias("path"), F.lit(0).alias("from"), F.col("n").cast("int").alias("to"), "d1")
    return spans.union(whole.select(spans.columns)).select("doc_id", "d1", "path", "from", "to")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Compacted paths of at least two occurrences: (path, n_words, occurrences, doc_id and start of the first)."""
    spans = repeated_spans(unique_ids(docs, id_col, text_col), length).where("path IS NOT NULL")
    return spans.groupBy("path", (F.col("to") - F.col("from")).alias("n_words")).agg(F.count("*").alias("occurrences"), F.min(F.struct("doc_id", "from")).alias("first"))


def cut_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with _n_words, _n_removed and _kept: the words outside repeated passages, joined by one space.

    A word goes if a window of ``length`` words over it also starts anywhere else, in the same document
    or another; windows are judged on the input. Null texts have no words. Every row is judged by its own text, also where
    ids are null or repeated; rows with the same id and text are one document. Windows are compared by 64-bit hashes. Names in
    ``docs`` must not begin with an underscore.
    """
    if not plain_ids(docs, id_col):
        rows, once = row_keyed(docs, id_col, text_col)
        cut = save(cut_passages(once, length=length).drop("text").withColumnRenamed("doc_id", "_row"))
        return rows.join(cut, "_row").select(*docs.columns, "_n_words", "_n_removed", "_kept")
    spans = repeated_spans(unique_ids(docs, id_col, text_col), length)
    spans = save(spans.groupBy(F.col("doc_id").alias("_id"), F.col("d1").alias("_d1")).agg(F.collect_list(F.struct("from", "to")).alias("_spans")))
    marked = join_texts(docs.withColumn("_id", F.col(id_col).cast("long")), spans, "_id", "left", row_bytes="56 + 32 * size(_spans)")
    schema = [f for f in docs.schema.fields]
    out = marked.select(*docs.columns, "_d1", "_spans")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return out.mapInArrow(_cut(docs.columns, text_col), f"{kinds}, _n_words bigint, _n_removed bigint, _kept string")
