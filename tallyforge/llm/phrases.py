"""Phrase collocation mining, level by level, with double-array tries over word numbers.

Texts are read once, into rows of distinct 64-bit word keys (a key holds the language) and the places of words among them, and words are counted. Words with fewer than
``least`` occurrences can be in no candidate: the others get numbers, and only neighbouring numbers are kept. Then, for phrases of
2, 3 and 4 words, numpy moves the states of all places of a text through a broadcast double-array trie of the frequent shorter
phrases, one word for all places at a time. A place where both the first and the last words but one give a state (the Apriori
condition) has a candidate, its state and the next word; tasks count them, Spark sums the counts, and those of ``least`` or
more are the next level of the trie.

Tries and word tables are broadcast in shards of at most NODES entries, by ranges of first words and of keys. One shard does where
they are few; with more, every shard takes a pass over the numbers and leaves out the condition on the last words, which
costs time and gives the same phrases. Scores, cuts and containment are joins of the counted phrases; all arithmetic is in
integers and decimals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import words as W
from tallyforge.llm.tables import save

#: Entries of one broadcast word table or trie; any number gives the same result.
NODES = 1_000_000
#: Ranges of first words that a shard is made of.
RANGES = 1024
#: Candidates and words are sent on when a task has met so many.
KEPT = 500_000
#: Bytes of text that are taken apart at once.
CHUNK_BYTES = 250_000
#: Rows of a batch of counted candidates.
SENT = 65_536
#: Words with their texts are sent on earlier, since a text takes more room than a number.
TEXTS_KEPT = 120_000
LONGEST = 4
U = np.uint64
_BREAK = np.arange(256, dtype=np.uint8)
_BREAK[list(b".,;:!?")] = 10
_SMALL = _BREAK.copy()
_SMALL[65:91] += 32
#: A word key has 63 bits; with the top bit it is a number already.
_DONE = U(1 << 63)


class Counter:
    """Counts of 64-bit values as they come, as sorted arrays."""

    def __init__(self):
        self.values, self.counts, self.parts, self.waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, values: np.ndarray, counts: np.ndarray | None = None) -> None:
        """Values as they come, or distinct ones with their counts."""
        self.parts.append(np.unique(values, return_counts=True) if counts is None else (values, counts))
        self.waiting += len(self.parts[-1][0])
        if self.waiting > KEPT // 2:
            self.merge()

    def merge(self) -> None:
        every = [(self.values, self.counts), *self.parts]
        self.parts, self.waiting = [], 0
        values, counts = (np.concatenate(x) for x in zip(*every, strict=True))
        order = np.argsort(values, kind="stable")  # merges parts, which are sorted
        values = values[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]]))
        self.values = values[first]
        self.counts = np.add.reduceat(counts[order], first) if len(first) else counts

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        out = self.values, self.counts
        self.__init__()
        return out


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _words(part: pa.RecordBatch) -> tuple[W.Words, np.ndarray, np.ndarray, bytes]:
    """Words, their keys, where pieces begin, and the lower-cased bytes of all texts."""
    texts = part["text"].fill_null("")
    _, places, raw = texts.buffers()
    if raw is not None:
        changed = pa.py_buffer(_BREAK[np.frombuffer(raw, np.uint8)])
        texts = pa.Array.from_buffers(texts.type, len(texts), [None, places, changed], offset=texts.offset)
    words = W.split_words(texts, lower=True)
    langs = np.array([_lang_hash(x) for x in part["lang"].to_pylist()], np.uint64)
    keys = W.mix(words.hash + langs[words.owner()]) & ~_DONE | U(1)
    begins = np.zeros(len(keys), bool)
    if len(keys):
        stops = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum((words.data >= 10) & (words.data <= 13), out=stops[1:])
        begins[1:] = stops[words.start[1:]] != stops[words.end[:-1]]
        begins[words.first[:-1][words.counts() > 0]] = True
    return words, keys, begins, _SMALL[words.data].tobytes()


def _with_breaks(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The values with a 0 before each place where a piece begins."""
    out = np.zeros(len(values) + int(begins.sum()), values.dtype)
    out[np.arange(len(values)) + np.cumsum(begins)] = values
    return out


def _texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings that lie from ``start`` to ``end`` in ``data``."""
    places = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=places[1:])
    taken = data[np.repeat(start - places[:-1], end - start) + np.arange(places[-1])]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(taken))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted, known, new = Counter(), np.zeros(0, np.uint64), []  # new: (keys, languages, words), of each key once

    def vocabulary() -> pa.RecordBatch:
        keys, counts = counted.taken()
        own, langs, texts = zip(*new, strict=True)
        order = pa.array(np.argsort(np.concatenate(own)))
        columns = {"lang": pa.concat_arrays(langs).take(order), "key": W.signed(keys), "word": pa.concat_arrays(texts).take(order)}
        none = pa.nulls(len(keys), pa.binary())
        return pa.RecordBatch.from_pydict(columns | {"n": pa.array(counts, pa.int64()), "keys": none, "seq": none})

    for part in W.chunks(batches, "text", CHUNK_BYTES):
        words, keys, begins, small = _words(part)
        some, first, place, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        unmet = ~np.isin(some, known, assume_unique=True)
        at = first[unmet]
        if len(at):
            langs = part["lang"].cast(pa.string()).take(pa.array(words.owner()[at]))
            new.append((some[unmet], langs, _texts(np.frombuffer(small, np.uint8), words.start[at], words.end[at])))
            known = np.concatenate([known, some[unmet]])
        counted.add(some, counts)
        none = [pa.nulls(1, t) for t in (pa.string(), pa.int64(), pa.string(), pa.int64())]
        places = _with_breaks((place + 1).astype(np.uint16 if len(some) < 65_535 else np.uint32), begins)
        own = [pa.array([x.tobytes()], pa.binary()) for x in (some, places)]
        yield pa.RecordBatch.from_arrays([*none, *own], names=["lang", "key", "word", "n", "keys", "seq"])
        if len(known) > TEXTS_KEPT:
            yield vocabulary()
            known, new = known[:0], []
    if new:
        yield vocabulary()


def _kept_runs(numbers: np.ndarray) -> np.ndarray:
    """Numbers next to another one, with one 0 after each run."""
    some = np.concatenate([[False], numbers > 0, [False]])
    near = some[1:-1] & (some[:-2] | some[2:])
    before = np.concatenate([[False], near[:-1]])
    return numbers[near | (before & ~near)]


def _numbers(shared: Broadcast, low: int, high: int, last: bool):
    """Replace a text's keys from low to high by numbers; the last turn leaves the texts as 32-bit numbers in runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = shared.value
        for batch in batches:
            out = {"keys": [], "seq": []}
            for raw, seq in zip(batch["keys"].to_pylist(), batch["seq"].to_pylist(), strict=True):
                keys = np.frombuffer(raw, np.uint64).copy()
                at = np.flatnonzero((keys >= U(low)) & (keys < U(high)))
                asked = keys[at]
                place = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
                hit = known[place] == asked if len(known) else np.zeros(len(at), bool)
                keys[at] = _DONE
                keys[at[hit]] |= numbers[place[hit]].astype(np.uint64)
                if last:
                    own = np.concatenate([[0], keys & ~_DONE]).astype(np.int32)
                    seq = _kept_runs(own[np.frombuffer(seq, np.uint16 if len(keys) < 65_535 else np.uint32)]).tobytes()
                    keys = keys[:0]
                out["keys"].append(keys.tobytes())
                out["seq"].append(seq)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary()) for k, v in out.items()})

    return run


def _forget(table: DataFrame) -> None:
    """Delete a written table that nothing reads any more, to keep the shared folder small."""
    files = table.inputFiles()
    if files:
        jvm, context = table.sparkSession._jvm, table.sparkSession.sparkContext
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, written, with numbers from 1 in no given order; the driver sees one count per partition."""
    df = save(df.withColumn("_at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = df.groupBy(part.alias("_part")).agg(F.count("*").alias("c")).orderBy("_part").collect()
    begin, starts = 1, []
    for r in counts:
        starts.append((r["_part"], begin))
        begin += r["c"]
    starts = df.sparkSession.createDataFrame(starts, "_part bigint, _begin bigint")
    return save(df.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, F.col("_begin") + inside).drop("_at", "_part", "_begin"))


class Trie:
    """A double array over the words of phrases whose first word lies between low and high.

    Slots 1 to high - low are the first words. A word is ``steps`` digits of ``bits`` bits; the child of slot s by digit d is slot
    base[s] + d, if check there is s. ``label`` has the phrase's number.
    """

    def __init__(self, low: int, high: int, most: int):
        width = max(int(most).bit_length(), 1)
        self.low, self.high, self.steps = low, high, 1 if width <= 8 else 2 if width <= 20 else 3
        self.bits = -(-width // self.steps)
        n = high - low + 1
        self.base, self.check = np.zeros(n, np.int32), np.full(n, -1, np.int32)
        self.label = np.arange(low - 1, high, dtype=np.int32)
        self.random = np.random.Generator(np.random.PCG64(low))

    def _room(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base, self.label = (np.concatenate([x, np.zeros(more, np.int32)]) for x in (self.base, self.label))
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def _children(self, parents: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """Slots for the children of ``parents`` by ``digits`` (distinct pairs, sorted): large families first, at random bases until free."""
        own, at, sizes = np.unique(parents, return_index=True, return_counts=True)
        slots = np.zeros(len(parents), np.int64)
        floor, width = self.high - self.low + 1, 1 << self.bits
        self._room(max(len(self.check) + 2 * len(parents), floor + 2 * width))
        order, poor = np.argsort(-sizes, kind="stable"), 0
        while len(order):
            # so few at once that they hardly meet each other
            some = order[: max(1, int(np.searchsorted(np.cumsum(sizes[order]), len(self.check) // 16)))]
            n = sizes[some]
            begin = np.concatenate([[0], np.cumsum(n)[:-1]])
            member = np.repeat(at[some] - begin, n) + np.arange(n.sum())
            family = np.repeat(np.arange(len(some)), n)
            base = self.random.integers(floor, len(self.check) - width, len(some))
            where = base[family] + digits[member]
            free = self.check[where] == -1
            first = np.full(len(some), True)
            first[family[~free]] = False
            _, earliest = np.unique(where, return_index=True)
            lost = np.ones(len(where), bool)
            lost[earliest] = False
            first[family[lost]] = False
            won = first[family]
            self.check[where[won]] = parents[member[won]]
            slots[member[won]] = where[won]
            self.base[own[some[first]]] = base[first]
            order = np.concatenate([some[~first], order[len(some) :]])
            poor = poor + 1 if 8 * first.sum() < len(some) else 0
            if poor == 16:  # too full for families of this size
                self._room(len(self.check) + max(width, len(self.check) // 8))
                poor = 0
        return slots

    def add(self, parents: np.ndarray, words: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Slots of phrases that are one word longer than those in the slots ``parents``."""
        path = parents.astype(np.int64)
        for step in reversed(range(self.steps)):
            digits = (words >> (step * self.bits)) & ((1 << self.bits) - 1)
            pairs, place = np.unique(path << 32 | digits, return_inverse=True)
            path = self._children(pairs >> 32, pairs & 0xFFFFFFFF)[place]
        self.label[path] = numbers
        return path

    def first(self, words: np.ndarray) -> np.ndarray:
        return np.where((words >= self.low) & (words < self.high), words - self.low + 1, 0)

    def next(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The states one word on; 0 is no state."""
        for step in reversed(range(self.steps)):
            to = self.base[states] + ((words >> (step * self.bits)) & ((1 << self.bits) - 1))
            np.minimum(to, len(self.check) - 1, out=to)
            states = np.where((self.check[to] == states) & (states > 0) & (words > 0), to, 0)
        return states


def _counted(shared: Broadcast, size: int, whole: bool):
    """(code, n): how often each candidate of ``size`` words is met; code is the number of its beginning and its last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, counted = shared.value, Counter()

        def found() -> Iterator[pa.RecordBatch]:
            codes, counts = counted.taken()
            for i in range(0, len(codes), SENT):
                yield pa.RecordBatch.from_pydict({"code": W.signed(codes[i : i + SENT]), "n": pa.array(counts[i : i + SENT], pa.int64())})

        for batch in batches:
            for raw in batch["seq"].to_pylist():
                numbers = np.concatenate([np.frombuffer(raw, np.int32), np.zeros(LONGEST, np.int32)])
                states = trie.first(numbers)
                for k in range(1, size - 1):
                    states = trie.next(states[:-1], numbers[k:])
                ahead = numbers[size - 1 : size - 1 + len(states)]
                states = states[: len(ahead)]
                met = (states > 0) & (ahead > 0)
                if whole:
                    met[:-1] &= states[1:] > 0
                    met[-1:] = False
                counted.add(trie.label[states[met]].astype(np.uint64) << U(32) | ahead[met].astype(np.uint64))
                if len(counted.values) > KEPT:
                    yield from found()
        yield from found()

    return run


def _summed(counts: DataFrame, least: int) -> DataFrame:
    """(code, a) of the codes with ``least`` or more.

    Tasks have counted already and hardly repeat a code, so rows are shuffled as they are: a second count before the shuffle
    would hold a task's codes on the heap and merge next to none.
    """
    return counts.repartition("code").groupBy("code").agg(F.sum("n").alias("a")).where(F.col("a") >= least)


def _shards(levels: list[DataFrame], most: int) -> list[tuple[int, int]]:
    """Ranges of first words with at most NODES phrases each (or one of RANGES parts of all words)."""
    width = most // RANGES + 1
    counts = np.zeros(RANGES + 1, np.int64)
    for level in levels:
        for r in level.groupBy(F.floor(F.get("words", F.lit(0)) / width).alias("r")).agg(F.count("*").alias("c")).collect():
            counts[r["r"]] += r["c"]
    out, low, total = [], 0, 0
    for i, c in enumerate(counts.tolist()):
        if total + c > NODES and total:
            out.append((low, i))
            low, total = i, 0
        total += c
    return [(max(a * width, 1), b * width) for a, b in [*out, (low, RANGES + 1)] if a * width <= most or not a]


def _trie(levels: list[DataFrame], low: int, high: int, most: int) -> Trie:
    trie = Trie(low, min(high, most + 1), most)
    first = F.get("words", F.lit(0)).between(low, high - 1)
    numbers, slots = np.arange(low, trie.high), np.arange(1, trie.high - low + 1)
    for level in levels[1:]:
        rows = level.where(first).select("number", "prefix", F.get("words", F.size("words") - 1).alias("word")).toArrow()
        number, prefix, word = (rows[c].to_numpy().astype(np.int64) for c in ("number", "prefix", "word"))
        slots = trie.add(slots[np.searchsorted(numbers, prefix)], word, number)
        order = np.argsort(number)
        numbers, slots = number[order], slots[order]
    return trie


def _levels(docs: DataFrame, least: int) -> tuple[list[DataFrame], DataFrame, DataFrame]:
    """Frequent phrases of 1 to LONGEST words (number, prefix, words, a), the numbers' words, and all words per language."""
    session, context = docs.sparkSession, docs.sparkSession.sparkContext
    read = save(docs.mapInArrow(_read, "lang string, key bigint, word string, n bigint, keys binary, seq binary"))
    words = save(read.where("seq IS NULL").groupBy("lang", "word").agg(F.sum("n").alias("a"), F.first("key").alias("key")))
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = numbered(words.where(F.col("a") >= least), "number")
    most = frequent.count()
    seq, turns, before = read.where("seq IS NOT NULL").select("keys", "seq"), most // NODES + 1, read
    for i in range(turns):
        low, high = (1 << 63) * i // turns, (1 << 63) * (i + 1) // turns
        rows = frequent.where(F.col("key").between(low, high - 1)).select("key", "number").orderBy("key").toArrow()
        shared = context.broadcast((rows["key"].to_numpy().astype(np.uint64), rows["number"].to_numpy().astype(np.int32)))
        seq = save(seq.mapInArrow(_numbers(shared, low, high, i == turns - 1), "keys binary, seq binary"))
        shared.destroy()
        _forget(before)
        before = seq
    levels = [frequent.select("number", F.lit(0).cast("long").alias("prefix"), F.array(F.col("number").cast("int")).alias("words"), "a")]
    for size in range(2, LONGEST + 1):
        shards = _shards(levels, most)
        counts = None
        for low, high in shards:
            shared = context.broadcast(_trie(levels, low, high, most))
            part = seq.select("seq").mapInArrow(_counted(shared, size, len(shards) == 1), "code bigint, n bigint")
            part = save(_summed(part, least))
            shared.destroy()
            counts = part if counts is None else counts.union(part)
        counts = numbered(counts.select(F.shiftright("code", 32).alias("prefix"), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("last"), "a"), "number")
        begin = levels[-1].select(F.col("number").alias("prefix"), F.col("words").alias("begin"))
        levels.append(save(counts.join(begin, "prefix").select("number", "prefix", F.concat("begin", F.array("last")).alias("words"), "a")))
    return levels, frequent.select("number", "lang", "word"), totals


def collocations(docs: DataFrame, least: int = 30, inside: int = 80, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases.

    A-Z count as a-z; a text is cut at ``. , ; : ! ?`` and \\n to \\r into pieces, these at spaces and tabs into words. Counts are per
    language (null: ``und``) over all rows, repeated ones included; null and empty texts have no words; other columns are ignored; an empty
    table gives no rows. Candidates: phrases of 2 to 4 words in one piece that occur ``a >= least`` times. Each cut in two has l and r
    occurrences of its parts and the score floor(2000000 a / (l + r)); the lowest counts, of equal ones the first. A candidate whose words
    lie inside a longer one with at least ``inside`` percent of its occurrences is dropped. Order: score and a descending, then the
    phrase by its bytes. Words are told apart in texts by 63-bit keys.
    """
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    levels, names, totals = _levels(docs, least)
    every = levels[0]
    for level in levels[1:]:
        every = every.union(level)
    every = save(every.select("words", "a"))
    long = every.where(F.size("words") > 1)

    cuts = long.select("words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("j"))
    cuts = cuts.withColumn("left", F.slice("words", F.lit(1), F.col("j"))).withColumn("right", F.slice("words", F.col("j") + 1, F.size("words") - F.col("j")))
    cuts = cuts.join(every.toDF("left", "l"), "left").join(every.toDF("right", "r"), "right")
    score = F.expr("CAST(a AS DECIMAL(30,0)) * 2000000 DIV (CAST(l AS DECIMAL(30,0)) + r)")
    best = cuts.groupBy("words", "a").agg(F.min(F.struct(score.alias("score"), "j", "l", "r")).alias("cut")).select("words", "a", "cut.score", "cut.l", "cut.r")

    size = F.size("words")
    spans = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.slice("words", i, k)))))
    around = save(long.where(size > 2).select("a", spans.alias("words")).groupBy("words").agg(F.max("a").alias("longer")))
    kept = best.join(around, "words", "left").where(F.coalesce(100 * F.col("longer").cast("decimal(30,0)") < inside * F.col("a"), F.lit(True))).drop("longer")

    kept = numbered(kept, "id")
    parts = kept.select("id", F.posexplode("words").alias("at", "number")).join(names, "number")
    texts = parts.groupBy("id").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = kept.join(texts, "id").join(save(totals), "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = 30, inside: int = 80, top: int = 2000) -> str:
    sql = r"""
    WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
    seqs AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w)) AS n FROM seqs GROUP BY lang),
    grams AS (SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM seqs, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
    counts AS (SELECT lang, g, count(*) AS a FROM grams GROUP BY lang, g HAVING count(*) >= LEAST_COUNT),
    cuts AS (SELECT c.lang, c.g, c.a, j, l.a AS l, r.a AS r, (CAST(c.a AS HUGEINT) * 2000000) // (l.a + r.a) AS score
        FROM (SELECT *, unnest(range(1, len(g))) AS j FROM counts WHERE len(g) > 1) c
        JOIN counts l ON l.lang = c.lang AND l.g = c.g[1:j] JOIN counts r ON r.lang = c.lang AND r.g = c.g[j + 1:len(c.g)]),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
    spans AS (SELECT lang, a, unnest(list_transform(range(1, len(g) - k + 2), lambda i: g[i:i + k - 1])) AS g FROM counts, (SELECT unnest([2, 3]) AS k) WHERE len(g) > k),
    around AS (SELECT lang, g, max(a) AS longer FROM spans GROUP BY lang, g),
    kept AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.g = b.g WHERE o.longer IS NULL OR 100 * o.longer < SHARE * b.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, CAST(t.n AS BIGINT) AS n, CAST(k.score AS BIGINT) AS score FROM ranked k JOIN totals t ON t.lang = k.lang WHERE k.rank <= TOP_ROWS
    """
    return " ".join(sql.replace("LEAST_COUNT", str(least)).replace("SHARE", str(inside)).replace("TOP_ROWS", str(top)).split())
