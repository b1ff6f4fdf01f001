"""Null and repeated ids: every row is judged by its own text."""

import brute
import pytest

import corpus_pipeline
from tallyforge.llm import decontaminate, jaccard, licenses, rules, substring

X = " ".join(f"x{i}" for i in range(60))
ITEM = " ".join(f"item{i}" for i in range(40))
BSD = next(body for label, body in licenses.TEMPLATES if label == "bsd")


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_no_leak_is_lost(spark):
    rows = [(7, "other text"), (7, f"before {ITEM} after"), (None, ITEM), (None, "clean"), (8, None), (9, ITEM)]
    bench = spark.createDataFrame([(1, ITEM), (2, "something else entirely here")], "item_id bigint, text string")
    found = decontaminate.leaks(docs_of(spark, rows), bench)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["item_id"], r["start"]) for r in found.collect()) == [(False, 7, 1, 1), (False, 9, 1, 0), (True, 0, 1, 0)]
    assert got(decontaminate.without_leaks(docs_of(spark, rows), bench)) == sorted([(7, "other text"), (None, "clean"), (8, None)], key=str)
    twice = spark.createDataFrame([(1, ITEM), (1, X), (None, "a b c d e f g h"), (1, ITEM)], "item_id bigint, text string")
    pairs = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs_of(spark, [(1, X), (2, ITEM), (3, "a b c d e f g h")]), twice).collect()}
    assert pairs == {(1, 1), (2, 1), (3, None)}


def test_no_window_is_missed(spark):
    rows = [(1, "other"), (1, X), (2, X), (None, f"q {X}"), (3, "clean text"), (1, "other")]
    cut = substring.cut_passages(docs_of(spark, rows))
    want = {i: (n, gone) for i, n, gone, _ in brute.cut_passages([(i, t) for i, (_, t) in enumerate(rows[:5])])}
    want = sorted([(d, t, *want[i]) for i, (d, t) in enumerate(rows[:5])] + [(1, "other", 1, 0)], key=str)
    assert got(cut.select("doc_id", "text", "_n_words", "_n_removed")) == want


def test_labels_stay_with_their_text(spark):
    rows = [(None, BSD), (5, "nothing here"), (5, BSD), (None, "mit license"), (None, "none")]
    out = {(r["doc_id"], r["n_words"]): r["labels"] for r in licenses.scan(docs_of(spark, rows)).collect()}
    n = next(k[1] for k in out if k[0] is None and k[1] > 5)
    assert out == {(None, n): "bsd", (5, 2): "", (5, n): "bsd", (None, 2): "mit", (None, 1): ""}


def test_no_row_is_left_out(spark):
    rows = [(1, X), (1, "a b c d e f"), (2, X + " end"), (None, X), (None, ""), (None, "z y x w v u"), (4, None), (1, X)]
    want = {i: (n, c) for i, n, c in brute.near_duplicates([(i, t) for i, (_, t) in enumerate(rows)])}
    least = {}
    for i, (d, _) in enumerate(rows):
        least[want[i][1]] = min((x for x in (least.get(want[i][1]), d) if x is not None), default=None)
    assert got(jaccard.near_duplicates(docs_of(spark, rows))) == sorted(((d, want[i][0], least[want[i][1]]) for i, (d, _) in enumerate(rows)), key=str)
    kept = got(jaccard.first_of_each(docs_of(spark, rows)))
    assert kept == sorted([(1, X), (1, "a b c d e f"), (None, ""), (None, "z y x w v u"), (4, None)], key=str)


def test_rules_reject_rows_not_ids(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(1, good), (1, "short"), (None, good), (None, "short"), (2, None)]
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert got(rules.kept(docs_of(spark, rows), labels)) == sorted([(1, good), (None, good)], key=str)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables(spark, sf_dir, name, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    assert stage(spark, docs, sf_dir).count() == 0
