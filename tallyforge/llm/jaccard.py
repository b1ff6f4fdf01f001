"""N-gram Jaccard join of documents by grouped prefixes, down to connected components.

Documents with the same shingle set form one class and are compared once. A class that shares fewer of its
shingles with any other class than the threshold demands has no partner and leaves early; the others
are few. Their shingles are ordered by document frequency, rarest first, and two similar sets share a shingle
within both prefixes (shingles that occur once need not be indexed, but count as places of the prefix).
Classes with equal prefix and size form a group, groups meet in the prefix index, group pairs pass the
length and position filters, and the members of the remaining pairs are compared exactly.

Of the pairs within one component only as many are compared as connect it: in some rounds every group meets one
hub for each of its keys and size bands, first the most typical ones, then others by chance; once the pairs left
between different components are no more than the index has rows, or hardly get fewer, all of them are compared. Every pair of linked
classes ends in one component, but thousands of near copies do not become millions of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import words as W
from tallyforge.llm.tables import components, join_texts, plain_ids, row_keyed, save, unique_ids

#: Share of the hash range whose shingles take part in the first count; any share gives the same result.
FIRST_COUNT = 0.4
#: At most so many rounds of hubs before all remaining pairs are compared; any number gives the same result.
HUB_ROUNDS = 8
#: So many keys before a place are kept with it; with any number the result is the same.
EARLIER = 64


def _sets(size: int, want: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.uint64(int(FIRST_COUNT * 2**64))
        for part in W.chunks(batches, "text"):
            values, ends = W.shingle_sets(W.split_words(part["text"], lower=True), size)
            out = {"doc_id": part["doc_id"]}
            if want == "digest":
                out |= {"n": pa.array(np.diff(ends), pa.int64()), "d1": W.signed(W.set_digest(values, ends, 1)), "d2": W.signed(W.set_digest(values, ends, 2))}
            elif want == "some":
                kept = values < limit
                out |= {"keys": W.lists(values[kept], np.concatenate([[0], np.cumsum(kept)])[ends])}
            else:
                out |= {"keys": W.lists(values, ends)}
            yield pa.RecordBatch.from_pydict(out)

    return run


def shingle_counts(docs: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, n, d1, d2): size and 128-bit digest of each document's set of distinct shingles."""
    return docs.mapInArrow(_sets(size, "digest"), "doc_id bigint, n bigint, d1 bigint, d2 bigint")


def _few_alone(sets: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """Those of ``sets`` (doc_id, n) that share enough of their keys with others to have a partner."""
    alone = keys.groupBy("key").agg(F.count("*").alias("c"), F.min("doc_id").alias("doc_id")).where("c = 1")
    alone = alone.groupBy("doc_id").agg(F.count("*").alias("alone"))
    return sets.join(alone, "doc_id", "left").where(100 * (F.col("n") - F.coalesce("alone", F.lit(0))) >= percent * F.col("n"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, lonely, key, place): the indexed part of each set's prefix.

    place counts from 1 over the whole order, in which the ``lonely`` shingles of no other set come first.
    """
    rows = sets.select("doc_id", "n", F.explode("keys").alias("key"))
    seen = rows.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    order = Window.partitionBy("doc_id").orderBy("df", "key")
    shared = rows.join(seen, "key").withColumn("i", F.row_number().over(order))
    total = shared.groupBy("doc_id").agg(F.count("*").alias("shared"))
    need = F.ceil(percent * F.col("n") / 100)
    return (
        shared.where(F.col("i") <= F.col("n") - need + 1)
        .join(total, "doc_id")
        .withColumn("lonely", F.col("n") - F.col("shared"))
        .select("doc_id", "n", "lonely", "key", (F.col("i") + F.col("lonely")).cast("int").alias("place"))
        .where(F.col("place") <= F.col("n") - need + 1)
    )


def _fits(percent: int, n1: str, n2: str, p1: str, p2: str, l1: str, l2: str) -> F.Column:
    """Sizes and places under which a shared key leaves enough overlap possible; lonely shingles never overlap."""
    before = F.least(F.col(p1) - F.col(l1), F.col(p2) - F.col(l2))
    overlap = before + F.least(F.col(n1) - F.col(p1), F.col(n2) - F.col(p2))
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * overlap >= percent * (F.col(n1) + F.col(n2)))


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of which the sets are similar enough, by comparing them whole."""
    a, b = (sets.select(F.col("doc_id").alias(x), F.col("keys").alias(f"{x}_keys")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").withColumn("same", F.size(F.array_intersect("a_keys", "b_keys")))
    return both.where(100 * F.col("same") >= percent * (F.size("a_keys") + F.size("b_keys") - F.col("same"))).select("a", "b")


def _hub_pairs(index: DataFrame, groups: DataFrame, found: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each group with one hub of its key in its size band and in the band below, if not connected yet."""
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / percent))).cast("int")
    rows = index.withColumn("band", band).join(found.toDF("g", "comp"), "g", "left").withColumn("comp", F.coalesce("comp", "g"))
    typical = F.col("lonely") if turn == 0 else F.lit(0)
    lead = F.struct(typical.alias("order"), F.xxhash64("g", "key", F.lit(turn)).alias("h"), F.col("g").alias("hub"), F.col("n").alias("hub_n"), F.col("place").alias("hub_place"), F.col("lonely").alias("hub_lonely"), F.col("comp").alias("hub_comp"))
    hubs = rows.groupBy("key", "band").agg(F.min(lead).alias("lead"), F.count("*").alias("c")).select("key", "band", "lead.*", "c")
    hubs = hubs.where("c > 1").drop("c", "order", "h").union(hubs.select("key", F.col("band") + 1, "hub", "hub_n", "hub_place", "hub_lonely", "hub_comp"))
    pairs = rows.join(hubs, ["key", "band"]).where(F.col("comp") != F.col("hub_comp")).where(_fits(percent, "n", "hub_n", "place", "hub_place", "lonely", "hub_lonely"))
    pairs = pairs.select(F.least("g", "hub").alias("a"), F.greatest("g", "hub").alias("b"))
    if turn == 0:
        pairs = pairs.union(groups.where("g <> doc_id").select(F.col("g").alias("a"), F.col("doc_id").alias("b")))
    return pairs.distinct()


def _members(groups: DataFrame, found: DataFrame) -> DataFrame:
    return groups.join(found.toDF("doc_id", "comp"), "doc_id", "left").select("g", "doc_id", F.coalesce("comp", "doc_id").alias("comp"))


def _sides(index: DataFrame, members: DataFrame) -> DataFrame:
    """The index by component, where a key has more than one."""
    sides = index.join(members.select("g", "comp").distinct(), "g")
    split = sides.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    at = F.col("place") - F.col("lonely")
    first = index.where(at <= EARLIER).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("p")).select("g", F.col("p.key").alias("p"))
    rows = sides.join(split, "key", "left_semi").join(first, "g")
    earlier = F.slice("p", F.lit(1), F.least(at - 1, F.lit(EARLIER)))
    return save(rows.select("key", "g", "n", "place", "lonely", "comp", earlier.alias("earlier")))


def _pairs_left(sides: DataFrame) -> int:
    """Pairs of groups of different components over all keys, before the filters."""
    own = sides.groupBy("key", "comp").agg(F.count("*").cast("decimal(38,0)").alias("c"))
    keys = own.groupBy("key").agg((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))).alias("p"))
    return int(keys.agg(F.sum("p")).first()[0] or 0) // 2


def _other_pairs(sides: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """All pairs of members that share a key, pass the filters, and are not in one component yet.

    A pair shows up at its first common key: not where the keys kept of earlier places have one in common. Where
    all earlier keys are kept, what follows that key bounds the overlap. The largest component of a key is not
    paired with itself.
    """
    size = sides.groupBy("key", "comp").agg(F.count("*").alias("c"))
    largest = size.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top")).select("key", (F.col("top.comp")).alias("top"))
    sides = save(sides.join(largest, "key").withColumn("large", F.col("comp") == F.col("top")).drop("top"))
    rest, large = sides.where("NOT large").drop("large"), sides.where("large").drop("large")
    fits = _fits(percent, "n1", "n2", "p1", "p2", "l1", "l2")
    known = (F.col("p1") - F.col("l1") <= EARLIER + 1) & (F.col("p2") - F.col("l2") <= EARLIER + 1)
    after = 1 + F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2"))
    fits = fits & (~known | ((100 + percent) * after >= percent * (F.col("n1") + F.col("n2")))) & ~F.arrays_overlap("e1", "e2")
    names = [["key", *(f"{c}{i}" for c in "gnplce")] for i in (1, 2)]
    one = rest.toDF(*names[0])
    pairs = one.join(rest.toDF(*names[1]), "key").where("c1 < c2").where(fits).unionByName(one.join(large.toDF(*names[1]), "key").where(fits))
    pairs = pairs.select("g1", "c1", "g2", "c2").distinct()
    m1, m2 = members.toDF("g1", "a", "c1"), members.toDF("g2", "b", "c2")
    return pairs.join(m1, ["g1", "c1"]).join(m2, ["g2", "c2"]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    A-Z count as a-z; a document's set is its distinct shingles of ``size`` words, or its whole word
    sequence where it has fewer. Two documents link when 100 * |both| >= percent * |either|; component_id is
    the smallest doc_id reachable by links, the document's own included. Null and word-free texts have no
    shingles and no links. Every row is judged by its own text, also where ids are null or repeated; a null id is no
    component_id unless no other is in reach. Other columns are ignored. Sets are compared by 64-bit shingle hashes.
    """
    if not plain_ids(docs, id_col):
        rows, found = _by_rows(docs, id_col, text_col, size, percent)
        return rows.select(F.col(id_col).cast("long").alias("doc_id"), "_row").join(found.select("_row", "n_shingles", "component_id"), "_row").drop("_row")
    docs = unique_ids(docs, id_col, text_col)
    counts = save(shingle_counts(docs, size))
    classes = counts.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("class_id"))
    members = save(counts.join(classes, ["n", "d1", "d2"], "left").select("doc_id", "n", F.coalesce("class_id", "doc_id").alias("class_id")))
    copies = members.where("doc_id <> class_id OR n = 0").select("doc_id")
    firsts = members.where("doc_id = class_id AND n > 0").select("doc_id", "n")

    some = join_texts(docs, copies, "doc_id", "left_anti").mapInArrow(_sets(size, "some"), "doc_id bigint, keys array<bigint>")
    likely = save(_few_alone(firsts, some.select("doc_id", F.explode("keys").alias("key")), percent).select("doc_id", "n"))
    whole = join_texts(docs, likely.select("doc_id"), "doc_id").mapInArrow(_sets(size, "all"), "doc_id bigint, keys array<bigint>")
    whole = save(whole.withColumn("n", F.size("keys").cast("long")))
    likely = save(_few_alone(likely, whole.select("doc_id", F.explode("keys").alias("key")), percent).select("doc_id"))
    sets = save(whole.join(likely, "doc_id", "left_semi"))

    prefixes = save(_prefixes(sets, percent))
    shape = prefixes.groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("prefix"))
    shape = shape.select("doc_id", "n", F.xxhash64("prefix").alias("h1"), F.xxhash64("prefix", F.lit(1)).alias("h2"))
    same = shape.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("g"))
    groups = save(shape.join(same, ["n", "h1", "h2"]).select("g", "doc_id"))
    index = save(prefixes.withColumnRenamed("doc_id", "g").join(groups.where("g = doc_id").select("g"), "g", "left_semi"))

    found = save(groups.where("false").toDF("node", "component"))
    rows, before = index.count(), None
    for turn in range(HUB_ROUNDS):
        links = _similar(_hub_pairs(index, groups, found, percent, turn), sets, percent)
        found = components(links.union(found.toDF("a", "b")))
        members_of = save(_members(groups, found))
        sides = _sides(index, members_of)
        left = _pairs_left(sides)
        if left <= rows or (before is not None and 2 * left > before):
            break
        before = left
    links = _similar(_other_pairs(sides, members_of, percent), sets, percent)
    found = components(links.union(found.toDF("a", "b")))

    joined = members.join(found.toDF("class_id", "component"), "class_id", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class_id").alias("component_id"))


def _by_rows(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """For null and repeated ids: the rows with _row, and (_row, n_shingles, component_id, first) of each distinct one.

    ``first`` marks the one of each component with the smallest id (nulls last).
    """
    rows, once = row_keyed(docs, id_col, text_col)
    found = near_duplicates(once, size=size, percent=percent).withColumnRenamed("doc_id", "_row").withColumnRenamed("component_id", "_comp")
    found = save(found.join(rows.select("_row", F.col(id_col).cast("long").alias("id")).distinct(), "_row"))
    lead = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_row")).alias("lead")
    leads = save(found.groupBy("_comp").agg(lead).select("_comp", F.col("lead.id").alias("component_id"), F.col("lead._row").alias("lead")))
    return rows, save(found.join(leads, "_comp").withColumn("first", F.col("_row") == F.col("lead")))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """The documents without those that have a smaller doc_id in their component; columns as they came.

    Where ids are null or repeated, one row of each component stays, the one with the smallest id (nulls last); texts without words stay.
    """
    if not plain_ids(docs, id_col):
        rows, found = _by_rows(docs, id_col, text_col, size, percent)
        rows = rows.join(found.where("first OR n_shingles = 0").select("_row", "n_shingles"), "_row")
        return rows.where("n_shingles > 0").dropDuplicates(["_row"]).union(rows.where("n_shingles = 0")).select(docs.columns)
    later = save(near_duplicates(docs, id_col, text_col, size, percent).where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)))
    return join_texts(docs, later, id_col, "left_anti").select(docs.columns)
