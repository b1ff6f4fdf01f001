import random
import re
from collections import Counter
from types import SimpleNamespace

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import phrases, queries

SCHEMA = "doc_id bigint, text string, lang string, n int, words array<int>"
ORDER = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, None) for i, (t, lang) in enumerate(rows)], SCHEMA)


def plain(rows, least, inside=80, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(brute.LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = {g: a for g, a in counts.items() if a >= least and len(g[1]) > 1}
    longer = Counter()
    for (lang, g), a in found.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                longer[lang, g[i : i + k]] = max(longer[lang, g[i : i + k]], a)
    out = []
    for lang in totals:
        rows = []
        for (of, g), a in found.items():
            if of == lang and 100 * longer[lang, g] < inside * a:
                cuts = [(2_000_000 * a // (counts[lang, g[:j]] + counts[lang, g[j:]]), j) for j in range(1, len(g))]
                score, j = min(cuts)
                rows.append((-score, -a, " ".join(g).encode(), counts[lang, g[:j]], counts[lang, g[j:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, totals[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def made(seed, n, words, langs=("en", "fr", None, "", "und")):
    pick = random.Random(seed)
    vocabulary = [pick.choice(["w", "W", "é", "\x01", "x\x1fy", " z", "😀"]) + str(i) for i in range(words)]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(pick.randrange(0, 60)):
            text += vocabulary[int(words * pick.random() ** 3)] + pick.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "\x0b", "!", " ?"])
        rows.append((pick.choice([text, text, None]) if pick.random() < 0.1 else text, pick.choice(langs)))
    return rows


def got(df):
    assert df.columns == list(ORDER)
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed, words, least", [(1, 6, 5), (2, 40, 4), (3, 400, 2), (4, 3, 1)])
def test_against_plain_python(spark, seed, words, least):
    rows = made(seed, 150, words)
    assert got(phrases.collocations(docs_of(spark, rows), least)) == plain(rows, least)


def test_shards_and_cut_lists_change_nothing(spark, monkeypatch):
    rows = made(5, 150, 60)
    monkeypatch.setattr(phrases, "NODES", 7)
    monkeypatch.setattr(phrases, "RANGES", 8)
    monkeypatch.setattr(phrases, "KEPT", 50)
    monkeypatch.setattr(phrases, "TEXTS_KEPT", 20)
    assert got(phrases.collocations(docs_of(spark, rows), 3, 60, 9)) == plain(rows, 3, 60, 9)


def test_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.sql(f"SELECT {', '.join(ORDER)} FROM ({queries.ORACLES['op11_phrase_collocations']})").fetchall()
    assert want and got(queries.op11_phrase_collocations(spark, sf_dir)) == sorted(want)


def test_edges(spark):
    assert phrases.collocations(docs_of(spark, [])).collect() == []
    assert phrases.collocations(docs_of(spark, [(None, "en"), ("", None), (" \n. ", "en"), ("one two", "en")])).collect() == []
    rows = [("a b " * 500_000, "en"), ("x" * 100_000 + " y z.", "fr"), *[("p q r s t", None)] * 40]
    assert got(phrases.collocations(docs_of(spark, rows))) == plain(rows, 30)


def test_counted_candidates_are_not_hashed_again_before_the_shuffle(spark, monkeypatch):
    plans, save = [], phrases.save

    def seen(df):
        if df.columns == ["code", "a"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return save(df)

    monkeypatch.setattr(phrases, "save", seen)
    rows = made(7, 60, 20)
    assert got(phrases.collocations(docs_of(spark, rows), 3)) == plain(rows, 3)
    assert len(plans) == phrases.LONGEST - 1
    for text in plans:
        below = text[text.index("Exchange") :]
        assert "Aggregate" not in below and "MapInArrow" in below


def test_candidates_leave_a_task_in_small_batches():
    pick = np.random.Generator(np.random.PCG64(8))
    numbers = pick.integers(0, 401, 400_000).astype(np.int32)
    batch = pa.RecordBatch.from_pydict({"seq": pa.array([numbers.tobytes()], pa.binary())})
    out = list(phrases._counted(SimpleNamespace(value=phrases.Trie(1, 401, 400)), 2, False)(iter([batch])))
    assert len(out) > 1 and max(b.num_rows for b in out) < 100_000
    codes, counts = (np.concatenate([b[c].to_numpy() for b in out]) for c in ("code", "n"))
    pairs = numbers[:-1].astype(np.int64) << 32 | numbers[1:]
    want = np.unique(pairs[(numbers[:-1] > 0) & (numbers[1:] > 0)], return_counts=True)
    assert (codes == want[0]).all() and (counts == want[1]).all()


@pytest.mark.parametrize("most", [200, 40_000, 3_000_000])
def test_double_array(most):
    pick = np.random.Generator(np.random.PCG64(most))
    trie = phrases.Trie(1, min(most, 5000) + 1, most)
    pairs = np.unique(np.stack([(pick.random(6000) ** 4 * 150).astype(np.int64) + 1, pick.integers(1, most + 1, 6000)], axis=1), axis=0)
    slots = trie.add(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)))
    assert len(set(slots.tolist())) == len(pairs)
    assert (trie.next(trie.first(pairs[:, 0]), pairs[:, 1].astype(np.int32)) == slots).all()
    assert (trie.label[slots] == np.arange(len(pairs))).all()
    assert len(trie.check) < trie.high + 8 * len(pairs) + (4 << trie.bits)
    known = set(map(tuple, pairs.tolist()))
    asked = np.stack([pick.integers(1, 160, 20_000), pick.integers(1, most + 1, 20_000)], axis=1)
    hit = trie.next(trie.first(asked[:, 0]), asked[:, 1].astype(np.int32)) > 0
    assert hit.tolist() == [tuple(x) in known for x in asked.tolist()]
