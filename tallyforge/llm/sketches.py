"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch has COORDS coordinates. In round after round every shingle of a set is thrown into one bin by a hash of its own, and
an empty bin takes the smallest hash thrown into it; what later rounds throw there is ignored. COORDS rounds of chance are
followed by one for each bin that throws everything into it, so every coordinate fills, and sets of any size, one
shingle included, get sketches whose share of equal coordinates keeps close to the Jaccard similarity. Large sets fill all bins in
one round or two, so a sketch takes time in proportion to the set plus COORDS * log(COORDS).

Equal sets form a class. Classes meet where a band of ROWS coordinates is equal: at a similarity of 0.8 a pair is missed with
probability 3e-7. Pairs whose one-bit sketches differ by more than MOST_BITS are dropped (a pair at 0.8 with probability below
1e-7), all others are compared by their whole sets. Of the pairs inside one component only as many are compared as connect it: in
some rounds every class meets the hub of each of its bands, a class that is hub wherever it can be, so these are few pairs. Classes
that still share a band with another component are mostly copies with too many edits. Bands can't tell them from near ones, but
their rarest shingles can: among these classes alone, pairs of different components are found by prefixes of their sets in the
order of document frequency, with size and place filters, and compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import words as W
from tallyforge.llm.tables import components, save

ROWS, BANDS = 7, 64
COORDS = ROWS * BANDS
#: Of COORDS bits; a pair at 0.8 differs in 45 on average with a deviation of 6.
MOST_BITS = 82
#: At most so many rounds of hubs before all remaining pairs are compared; any number gives the same result.
HUB_ROUNDS = 6
#: Hashes worked out at once.
BLOCK = 400_000
U = np.uint64
EMPTY = U(2**64 - 1)
_random = np.random.Generator(np.random.PCG64(12))
_SALTS = _random.integers(0, 2**64, 2 * COORDS, dtype=np.uint64)
_ODD = _random.integers(0, 2**63, ROWS, dtype=np.uint64) * U(2) + U(1)
_BAND = _random.integers(0, 2**64, BANDS, dtype=np.uint64)


def _throw(out: np.ndarray, values: np.ndarray, own: np.ndarray, rounds: np.ndarray) -> None:
    """Throw each value into one bin of its set's sketch in every round; ``own`` is where that sketch begins in ``out``."""
    share = max(1, BLOCK // len(rounds))
    by_chance = rounds < COORDS
    for at in range(0, len(values), share):
        h = W.mix(values[None, at : at + share] ^ _SALTS[rounds][:, None])
        bins = np.where(by_chance[:, None], ((h >> U(32)) * U(COORDS)) >> U(32), np.maximum(rounds - COORDS, 0).astype(np.uint64)[:, None])
        code = ((h << U(32) | h >> U(32)) >> U(10)) | rounds.astype(np.uint64)[:, None] << U(54)
        np.minimum.at(out, (bins.astype(np.int64) + own[None, at : at + share]).ravel(), code.ravel())


def similarity_sketches(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sketch of each run of distinct values; an empty set has EMPTY coordinates only."""
    sizes = np.diff(ends)
    out = np.full(len(sizes) * COORDS, EMPTY)
    table = out.reshape(len(sizes), COORDS)
    classes = np.frexp(sizes)[1]
    for c in np.unique(classes[sizes > 0]):
        todo, done = np.flatnonzero(classes == c), 0
        step = max(1, int(COORDS * (np.log(COORDS) + 1)) >> int(c - 1))
        while len(todo) and done < 2 * COORDS:
            rounds = np.arange(done, min(done + step, 2 * COORDS))
            n = sizes[todo]
            shift = ends[todo] - np.concatenate([[0], np.cumsum(n)[:-1]])
            _throw(out, values[np.repeat(shift, n) + np.arange(n.sum())], np.repeat(todo * COORDS, n), rounds)
            done, step = done + step, max(1, step // 3)
            todo = todo[(table[todo] == EMPTY).any(axis=1)]
    return table


def band_keys(sketch: np.ndarray) -> np.ndarray:
    return W.mix((sketch.reshape(-1, BANDS, ROWS) * _ODD).sum(axis=2, dtype=np.uint64) + _BAND, 3)


def one_bit(sketch: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, in COORDS / 64 numbers."""
    return np.packbits((W.mix(sketch, 4) >> U(63)).astype(np.uint8), axis=1).view(np.uint64)


def _marks(size: int, want: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            values, ends = W.shingle_sets(W.split_words(part["text"], lower=True), size)
            out = {"n": pa.array(np.diff(ends), pa.int64()), "d1": W.signed(W.set_digest(values, ends, 1)), "d2": W.signed(W.set_digest(values, ends, 2))}
            if want == "keys":
                yield pa.RecordBatch.from_pydict(out | {"keys": W.lists(values, ends)})
                continue
            sketch = similarity_sketches(values, ends)
            every = np.arange(len(sketch) + 1)
            out |= {"bands": W.lists(band_keys(sketch).ravel(), every * BANDS), "bits": W.lists(one_bit(sketch).ravel(), every * (COORDS // 64))}
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"]} | out)

    return run


SET = ["n", "d1", "d2"]
MARKS = "doc_id bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>, bits array<bigint>"


def _alike(a: str, b: str) -> F.Column:
    """Whether two one-bit sketches are near enough."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(COORDS // 64)), F.lit(0)) <= MOST_BITS


def _sizes_fit(percent: int, a: str, b: str) -> F.Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets are similar enough; one-bit sketches go first."""
    bits = [sets.select(F.col("node").alias(x), F.col("bits").alias(f"{x}_bits")) for x in "ab"]
    pairs = save(pairs.join(bits[0], "a").join(bits[1], "b").where(_alike("a_bits", "b_bits")).select("a", "b"))
    keys = [sets.select(F.col("node").alias(x), F.col("keys").alias(f"{x}_keys")) for x in "ab"]
    both = pairs.join(keys[0], "a").join(keys[1], "b").withColumn("same", F.size(F.array_intersect("a_keys", "b_keys")))
    return both.where(100 * F.col("same") >= percent * (F.size("a_keys") + F.size("b_keys") - F.col("same"))).select("a", "b")


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The band rows with the component of each class, of bands that hold more than one component."""
    rows = rows.join(found.toDF("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    return save(rows.join(save(mixed), "key", "left_semi"))


def _hub_pairs(placed: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each class with the hub of each of its bands that is in another component."""
    lead = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"))
    hubs = save(placed.groupBy("key").agg(F.min(lead).alias("lead")).select("key", "lead.hub", "lead.hub_n", "lead.hub_comp"))
    met = placed.join(hubs, "key").where((F.col("comp") != F.col("hub_comp")) & _sizes_fit(percent, "n", "hub_n"))
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _pairs_left(placed: DataFrame) -> int:
    """Pairs of classes in different components over all bands, before any filter."""
    own = placed.groupBy("key", "comp").agg(F.count("*").cast("decimal(38,0)").alias("c"))
    keys = own.groupBy("key").agg((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))).alias("p"))
    return int(keys.agg(F.sum("p")).first()[0] or 0) // 2


def _prefixes(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, comp, place): of each set its rarest shingles, as far as one of them must be common with any similar set.

    Frequencies are those within ``nodes``. Shingles of one set only count as places, but need no row; neither do those of one component.
    """
    rows = nodes.join(sets.select("node", F.explode("keys").alias("key")), "node")
    seen = save(rows.groupBy("key").agg(F.count("*").alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("df > 1"))
    own = Window.partitionBy("node")
    shared = rows.join(seen, "key").withColumns({"i": F.row_number().over(own.orderBy("df", "key")), "shared": F.count("*").over(own)})
    shared = shared.withColumn("place", F.col("i") + F.col("n") - F.col("shared"))
    return shared.where((F.col("place") <= F.col("n") - F.ceil(percent * F.col("n") / 100) + 1) & (F.col("lo") < F.col("hi"))).select("key", "node", "n", "comp", "place")


def _other_pairs(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes in different components that a common prefix shingle and the filters allow; a key's largest component is not paired with itself."""
    index = save(_prefixes(placed.select("node", "n", "comp").distinct(), sets, percent))
    size = index.groupBy("key", "comp").agg(F.count("*").alias("c"))
    top = save(size.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top")).select("key", F.col("top.comp").alias("top")))
    index = save(index.join(top, "key").join(sets.select("node", "bits"), "node").withColumn("large", F.col("comp") == F.col("top")).drop("top"))
    columns = ["key", "node", "n", "comp", "place", "bits"]
    rest, large = (index.where(x).select(columns) for x in ("NOT large", "large"))
    # the first common shingle leaves each set enough shingles for the overlap that both sizes demand
    after = F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) + 1
    fits = _sizes_fit(percent, "n1", "n2") & ((100 + percent) * after >= percent * (F.col("n1") + F.col("n2"))) & _alike("bits1", "bits2")
    one, other, top_side = (x.toDF(*(f"{c}{i}" for c in columns)) for x, i in ((rest, 1), (rest, 2), (large, 2)))
    same = F.col("key1") == F.col("key2")
    pairs = one.join(other, same & (F.col("comp1") < F.col("comp2")) & fits).select("node1", "node2")
    pairs = pairs.union(one.join(top_side, same & fits).select("node1", "node2"))
    return pairs.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    A-Z count as a-z; a row's set is its distinct shingles of ``size`` words, or its whole word sequence where it has fewer. Two rows
    link when 100 * |both| >= percent * |either|; component_id is the smallest doc_id reachable by links, the row's own included;
    kept says whether that is its own. Every row is judged by its own text, so rows may share a doc_id; a null doc_id is never a
    component_id unless nothing else is in reach (then both are null and the row is kept). Null and word-free texts have no shingles
    and no links. Other columns are ignored; an empty table gives no rows. ``percent`` should be 80 or more: below, bands of
    ROWS coordinates begin to miss pairs. Sets are compared by 64-bit shingle hashes.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marks = save(texts.mapInArrow(_marks(size, "sketch"), MARKS))
    classes = marks.where("n > 0").groupBy(SET).agg(F.min("doc_id").alias("first_id"), F.any_value("bands").alias("bands"), F.any_value("bits").alias("bits"))
    classes = save(classes.withColumn("node", F.monotonically_increasing_id()))

    rows = classes.select("node", "n", F.explode("bands").alias("key"))
    shared = save(rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"))
    rows = save(rows.join(shared, "key", "left_semi"))
    met = classes.join(save(rows.select("node").distinct()), "node", "left_semi").select("node", "bits", *SET)
    whole = texts.select("text").mapInArrow(_marks(size, "keys"), "n bigint, d1 bigint, d2 bigint, keys array<bigint>")
    sets = save(whole.join(save(met), SET).groupBy("node").agg(F.any_value("bits").alias("bits"), F.any_value("keys").alias("keys")))

    found = save(rows.where("false").select("node", F.col("node").alias("comp")))
    placed = _placed(rows, found)
    before = _pairs_left(placed)
    for turn in range(HUB_ROUNDS):
        links = _verified(_hub_pairs(placed, percent, turn), sets, percent)
        found = components(links.union(found.toDF("a", "b")))
        placed = _placed(rows, found)
        left = _pairs_left(placed)
        if 2 * left > before:
            break
        before = left
    links = _verified(_other_pairs(placed, sets, percent), sets, percent)
    found = components(links.union(found.toDF("a", "b")))

    classes = classes.join(found.toDF("node", "comp"), "node", "left").select(*SET, "first_id", F.coalesce("comp", "node").alias("comp"))
    least = save(classes.groupBy("comp").agg(F.min("first_id").alias("component_id")))
    labels = save(classes.join(least, "comp").select(*SET, "component_id"))
    joined = marks.select("doc_id", *SET).join(labels, SET, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
