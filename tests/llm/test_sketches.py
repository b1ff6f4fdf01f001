import random

import brute
import numpy as np
import pytest

from tallyforge.llm import sketches

SCHEMA = "doc_id bigint, text string, n bigint, bands int"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, 1, 1) for d, t in rows], SCHEMA)


def plain(rows):
    """(doc_id, n, component, kept) of rows that may share ids: links between rows, labels by the least id in reach."""
    found = {i: (n, c) for i, n, c in brute.near_duplicates([(i, t) for i, (_, t) in enumerate(rows)], 2, 80)}
    least = {}
    for i, (d, _) in enumerate(rows):
        c = found[i][1]
        least[c] = min((x for x in (least.get(c), d) if x is not None), default=None)
    return sorted(((d, found[i][0], least[found[i][1]], d == least[found[i][1]]) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(seed, groups=12, vocabulary=10**6):
    pick = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{pick.randrange(vocabulary)}" for _ in range(pick.choice([1, 2, 3, 5, 6, 11, 40, 200]))]
        for _ in range(pick.randrange(1, 9)):
            copy = list(base)
            for _ in range(pick.randrange(0, 2 + len(copy) // 12)):
                copy[pick.randrange(len(copy))] = f"w{pick.randrange(vocabulary)}"
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    return rows


def test_coordinates_tell_similarity():
    pick = np.random.Generator(np.random.PCG64(1))
    for size in (1, 2, 5, 30, 700, 20_000):
        a = np.unique(pick.integers(0, 2**64, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[len(a) // 5 :], pick.integers(0, 2**64, len(a) // 5, dtype=np.uint64)]))
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sketch = sketches.similarity_sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b), len(a) + len(b)]))
        assert (sketch[:2] != sketches.EMPTY).all() and (sketch[2] == sketches.EMPTY).all()
        assert abs((sketch[0] == sketch[1]).mean() - want) < 0.09
        alone = sketches.similarity_sketches(b, np.array([0, len(b)]))
        assert (alone[0] == sketch[1]).all()


def test_few_pairs_at_the_threshold_are_missed():
    pick = np.random.Generator(np.random.PCG64(2))
    missed = far = 0
    for _ in range(300):
        size = int(pick.choice([5, 9, 18, 90, 900]))
        a = pick.integers(0, 2**64, size, dtype=np.uint64)
        b = np.concatenate([a[: size - size // 9], pick.integers(0, 2**64, size // 9, dtype=np.uint64)])
        s = sketches.similarity_sketches(np.concatenate([np.unique(a), np.unique(b)]), np.array([0, size, 2 * size]))
        missed += not (sketches.band_keys(s)[0] == sketches.band_keys(s)[1]).any()
        bits = sketches.one_bit(s)
        far += int(np.bitwise_count(bits[0] ^ bits[1]).sum()) > sketches.MOST_BITS
    assert (missed, far) == (0, 0)


@pytest.mark.parametrize("vocabulary", [4, 60, 10**6])
def test_components_against_plain_python(spark, vocabulary):
    rows = near_copies(vocabulary, 25, vocabulary)
    assert got(sketches.near_duplicates(docs_of(spark, rows))) == plain(rows)


def test_all_pairs_stage_and_hot_groups(spark, monkeypatch):
    pick = random.Random(3)
    common = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join(common + [f"x{pick.randrange(10**6)}" for _ in range(pick.choice([6, 14, 40]))])) for i in range(150)]
    rows += [(1000 + i, " ".join(common[i % 3 :])) for i in range(100)]
    want = plain(rows)
    for rounds in (0, 1, 6):
        monkeypatch.setattr(sketches, "HUB_ROUNDS", rounds)
        assert got(sketches.near_duplicates(docs_of(spark, rows))) == want


def test_copies_with_too_many_edits_meet_few(spark):
    """Near copies and far copies of one text: far ones share bands with all, but hardly a rare shingle with any."""
    pick = random.Random(8)
    base, rows = [f"b{i}" for i in range(150)], []
    for i in range(400):
        copy = list(base)
        for at in pick.sample(range(150), 3 if i % 4 else 12):
            copy[at] = f"w{pick.randrange(300)}"
        rows.append((i, " ".join(copy)))
    made = []
    real = sketches._other_pairs
    sketches._other_pairs = lambda *a: made.append(real(*a)) or made[-1]
    try:
        out = got(sketches.near_duplicates(docs_of(spark, rows)))
    finally:
        sketches._other_pairs = real
    assert out == plain(rows)
    assert made[0].count() < 4 * len(rows)


def test_null_and_repeated_ids(spark):
    x, y = " ".join(f"x{i}" for i in range(30)), " ".join(f"y{i}" for i in range(30))
    rows = [(1, "other"), (1, x), (2, x + " end"), (None, x), (None, y), (None, y), (3, None), (4, ""), (5, " \n"), (6, "one"), (7, "ONE"), (8, "One"), (8, "one"), (9, "two"), (1, x)]
    assert got(sketches.near_duplicates(docs_of(spark, rows))) == plain(rows)


def test_empty_table_and_a_long_text(spark):
    assert sketches.near_duplicates(docs_of(spark, [])).collect() == []
    pick = random.Random(4)
    long = [f"w{pick.randrange(10**6)}" for _ in range(400_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:360_000])), (3, " ".join(long[:250_000])), (4, "same " * 300_000), (5, "same same")]
    assert got(sketches.near_duplicates(docs_of(spark, rows))) == plain(rows)
