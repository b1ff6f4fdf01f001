import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import bpe, classifier, decontaminate, jaccard, queries, substring, tokencount
from tallyforge.llm import words as W
from tallyforge.llm.tables import save

SCHEMA = "doc_id bigint, text string, lang string, n bigint, path string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", 3, "p") for d, t in rows], SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rewritten(rng, text, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """Exact and near copies, shared passages, repeats within a text, empty, short and very long texts."""
    rng = random.Random(4)
    texts = [None, "", " \n\t", "one", "One", "one two three four", "one two three four", "a b c d e", "A b c d e f"]
    seed = prose(rng, 120)
    texts += [seed, seed, seed.upper(), "  " + seed.replace(" ", "\n")]
    texts += [rewritten(rng, seed, k) for k in (1, 1, 2, 2, 3, 3, 4, 5, 6)]
    passage = prose(rng, 60, 10**6)
    texts += [f"{prose(rng, 50, 10**6)} {passage} {prose(rng, rng.randrange(80), 10**6)}" for _ in range(12)]
    texts += [passage, passage[: len(passage) // 2], " ".join(passage.split()[:35]), " ".join(passage.split()[:34]), " ".join([passage, "x", passage])]
    texts += ["again and " * 60, "go " * 100, " ".join(["tick"] * 36), prose(rng, 30_000, 10**6)]
    words = prose(rng, 400, 10**6).split()
    texts += [" ".join(words[i : i + 40 + i]) for i in range(0, 100, 7)]
    texts += ["naïve café ﬁne text   kept " + prose(rng, 40), "a\x1cb\x85c d\x00e " * 9]
    return list(enumerate(texts))


def test_words_match_the_definition():
    texts = ["", None, " a  b\tc\x0bd\x0ce\r\nf ", "é è  x", "x"]
    words = W.split_words(pa.array(texts).slice(0), lower=True)
    assert words.counts().tolist() == [len(brute.WORD.findall(t or "")) for t in texts]
    same = W.split_words(pa.array(["AbC abc ABC abd É é"]), lower=True).hash
    assert len(set(same[:3].tolist())) == 1 and len(set(same.tolist())) == 4
    sliced = W.split_words(pa.array(["zz", "a b", "c"]).slice(1, 2))
    assert sliced.counts().tolist() == [2, 1]


def test_near_duplicates(spark, copies):
    got = jaccard.near_duplicates(frame(spark, copies)).collect()
    assert {tuple(r) for r in got} == brute.near_duplicates(copies)
    assert len(got) == len(copies)


def test_near_duplicates_of_one_large_group(spark):
    rng = random.Random(9)
    seed = prose(rng, 90, 10**6)
    rows = list(enumerate(rewritten(rng, seed, rng.randrange(1, 5)) for _ in range(300)))
    assert {tuple(r) for r in jaccard.near_duplicates(frame(spark, rows)).collect()} == brute.near_duplicates(rows)


def test_near_duplicates_by_chains(spark):
    rng = random.Random(3)
    rows, text = [], prose(rng, 100, 10**6)
    for i in range(60):
        rows.append((i, text))
        text = rewritten(rng, text, 1 + i % 3)
    assert {tuple(r) for r in jaccard.near_duplicates(frame(spark, rows)).collect()} == brute.near_duplicates(rows)


def test_ids_that_are_null_or_repeated(spark):
    rows = [(1, "b c d e f g"), (1, "a b c d e f g"), (1, "b c d e f g"), (None, "a b c d e f g"), (2, "a b c d e f g")]
    assert sorted(map(tuple, jaccard.near_duplicates(frame(spark, rows)).collect()), key=str) == [(1, 2, 1), (1, 2, 1), (1, 3, 1), (2, 3, 1), (None, 3, 1)]


def test_first_of_each_keeps_columns(spark, copies):
    out = jaccard.first_of_each(frame(spark, copies))
    assert out.columns == ["doc_id", "text", "lang", "n", "path"]
    assert {r["doc_id"] for r in out.collect()} == {d for d, _, c in brute.near_duplicates(copies) if d == c}


def digest(df):
    return {(r["doc_id"], r["_n_words"], r["_n_removed"], hashlib.sha256(r["_kept"].encode()).hexdigest()) for r in df.collect()}


def test_cut_passages(spark, copies):
    out = substring.cut_passages(frame(spark, copies))
    assert out.columns == ["doc_id", "text", "lang", "n", "path", "_n_words", "_n_removed", "_kept"]
    assert digest(out) == brute.cut_passages(copies)


@pytest.mark.parametrize("seed", range(3))
def test_cut_passages_of_small_vocabularies(spark, seed):
    rng = random.Random(seed)
    parts = [prose(rng, rng.randrange(5, 70), 3) for _ in range(10)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 7)))) for i in range(60)]
    assert digest(substring.cut_passages(frame(spark, rows))) == brute.cut_passages(rows)


def test_repeated_passages(spark):
    rng = random.Random(5)
    passage = prose(rng, 200, 10**6)
    rows = [(i, f"{prose(rng, 50, 10**6)} {passage} {prose(rng, 50, 10**6)}") for i in range(12)]
    (path,) = substring.repeated_passages(frame(spark, rows)).collect()
    assert path["occurrences"] == 12 and 100 < path["n_words"] <= 200 and path["first"]["doc_id"] == 0


def test_leaks(spark, copies):
    rng = random.Random(8)
    items = [(i, prose(rng, n, 10**6)) for i, n in enumerate((3, 4, 5, 8, 20, 40, 40, 57))]
    items += [(10, None), (11, ""), (12, "la " * 30), (13, items[5][1].upper())]
    rows = list(copies)
    for i, (_, body) in enumerate(items):
        for k in range(4):
            rows.append((1000 + 10 * i + k, f"{prose(rng, 30)} {rewritten(rng, body or 'x', k)} {prose(rng, 30)}"))
        rows.append((2000 + i, (body or "")[: int(len(body or "") * 0.9)]))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.leaks(frame(spark, rows), table).collect()
    assert {(r["doc_id"], r["item_id"], r["n_windows"], round(r["similarity"], 9)) for r in got} == brute.leaks(rows, items)
    clean = decontaminate.without_leaks(frame(spark, rows), table)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - {r["doc_id"] for r in got}


def test_leaks_in_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 30)
    rng = random.Random(1)
    items = [(i, prose(rng, 20, 10**6)) for i in range(6)]
    rows = [(i, f"{prose(rng, 20)} {items[i % 6][1]}") for i in range(12)]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(frame(spark, rows), table).collect()} == {(i, i % 6) for i in range(12)}


def test_leaks_with_a_run_of_one_word(spark):
    rng = random.Random(5)
    sides = [(prose(rng, 108, 10**6), prose(rng, 108, 10**6)) for _ in range(12)]
    items = [(i, f"{a} {'la ' * 30}{b}") for i, (a, b) in enumerate(sides)]
    rows = [(i, f"{prose(rng, 9)} {a} {'mi ' * 30}{b} {prose(rng, 9)}") for i, (a, b) in enumerate(sides)]
    got = decontaminate.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = brute.leaks(rows, items)
    assert {(d, i) for d, i, *_ in want} == {(i, i) for i in range(12)}
    assert {(r["doc_id"], r["item_id"], r["n_windows"], round(r["similarity"], 9)) for r in got} == want


def test_windows_are_taken_for_items_of_their_own_size_only(spark, monkeypatch):
    rng = random.Random(2)
    items = [(n, prose(rng, n, 10**6)) for n in range(14, 54)]
    rows = [(n, f"{prose(rng, 30)} {body} {prose(rng, 30)}") for n, body in items]
    saved = []
    monkeypatch.setattr(decontaminate, "save", lambda df: saved.append(save(df)) or saved[-1])
    got = decontaminate.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["n_windows"], round(r["similarity"], 9)) for r in got} == brute.leaks(rows, items)
    (hits,) = [df for df in saved if "start" in df.columns]
    assert hits.where("size <> doc_id").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_leaks_of_small_vocabularies(spark, monkeypatch, seed):
    monkeypatch.setattr(decontaminate, "WINDOW_GRAMS", 40)
    rng = random.Random(seed)
    parts = [prose(rng, rng.randrange(3, 20), 3) for _ in range(8)]
    items = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))) for i in range(25)] + [(30 + n, prose(rng, n, 3)) for n in range(1, 7)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))) for i in range(40)] + [(50 + n, prose(rng, n, 3)) for n in range(12)]
    got = decontaminate.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["n_windows"], round(r["similarity"], 9)) for r in got} == brute.leaks(rows, items)


@pytest.fixture(scope="module")
def codec():
    with open(queries.RANKS, "rb") as f:
        return bpe.codec_of(f.read(), queries.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return brute.tokenizer()


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(), st.text("abcdeéß '\n 12"), st.text(" \t\n  x"), st.text("ththerinand"), st.text("ab").map(lambda s: s * 9)))
def test_ids_equal_the_merges(codec, reference, text):
    assert ids(codec, text) == reference.encode_ordinary(text)
    assert bpe.decode_ids(codec.encode(text), codec.bytes) == text.encode()


def test_every_character_class(codec, reference):
    for a in range(0, 0x11000, 37):
        text = "".join(f"x{chr(c)} {chr(c)}y{chr(c)}{chr(c)}" for c in range(a, a + 37) if not 0xD800 <= c < 0xE000)
        assert ids(codec, text) == reference.encode_ordinary(text)


def test_long_pieces(codec, reference):
    for text in ("a" * 600, " " * 600, "ab" * 300 + "'s", "0123456789" * 60, "é" * 300, "=" * 400, "thtion" * 100):
        assert ids(codec, text) == reference.encode_ordinary(text)
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(200_000))
    assert bpe.decode_ids(codec.encode(long), codec.bytes) == long.encode()


def test_encode_and_decode_frames(spark, copies, reference):
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in copies] + [(None, "a", "x", 1)], "doc_id bigint, text string, tokens string, decoded int")
    encoded = bpe.encode(rows, queries.RANKS, queries.PATTERN)
    same = bpe.encode(rows, queries.RANKS, queries.PATTERN, decoded=True)
    out = bpe.decode(encoded, queries.RANKS)
    assert sorted(map(str, same.select(out.columns).collect())) == sorted(map(str, out.collect()))
    assert sorted(out.columns) == ["decoded", "doc_id", "n_tokens", "text", "tokens"]
    for r in out.collect():
        want = reference.encode_ordinary(r["text"] or "")
        assert np.frombuffer(r["tokens"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


@settings(max_examples=200, deadline=None)
@given(st.text("abc '\n1é.s", max_size=300), st.lists(st.tuples(st.integers(-2, 320), st.integers(-1, 40), st.text("abc '\nrevs1 ", max_size=12)), max_size=5))
def test_edits_keep_the_counts(codec, text, edits):
    tree = tokencount.build_tree(text, codec)
    assert tree.tokens == len(ids(codec, text))
    for at, cut, put in edits:
        text, _ = tokencount.edit(text, tree, at, cut, put, codec)
        assert tree.tokens == len(ids(codec, text))
        assert tree.chars[1] == len(text)
        tree = tokencount.Tree.unpack(tree.pack())


def test_edits_touch_little(codec):
    text = prose(random.Random(2), 5000)
    tree = tokencount.build_tree(text, codec)
    text, n = tokencount.edit(text, tree, 9000, 5, "middle of it", codec)
    assert n <= 3 * tokencount.LEAF and tree.tokens == len(ids(codec, text))
    text, n = tokencount.edit(text, tree, 200, 3, prose(random.Random(3), 3000), codec)
    assert tree.tokens == len(ids(codec, text))


def test_edit_frames(spark, copies, codec):
    edits = [(0, 2, "new "), (10**9, 5, " end"), None, (5, None, None), (None, 1, "é")]
    rows = spark.createDataFrame([(d, t, edits if d % 3 else None, "x") for d, t in copies], "doc_id bigint, text string, edits array<struct<at:bigint,cut:bigint,put:string>>, tree string")
    for r in tokencount.apply_edits(tokencount.build(rows, queries.RANKS, queries.PATTERN), queries.RANKS, queries.PATTERN).collect():
        assert r["n_tokens"] == len(ids(codec, r["text"] or ""))


def test_classifier_learns_and_calibrates(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, " ".join(f"{'q' if bad and rng.random() < 0.7 else 'w'}{rng.randrange(60)}{'$$$' if bad and rng.random() < 0.5 else ''}" for _ in range(40))))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(700, None), (701, ""), (None, "w1 w2 w3")]
    out = classifier.scored(frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    truth = dict((d, q) for d, q, _ in labels)
    held = [r for r in out if r["held_out"]]
    import zlib

    assert {r["doc_id"] for r in held} == {d for d, _ in rows if d is not None and zlib.crc32(str(d).encode()) % 5 == 0}
    assert np.mean([truth[r["doc_id"]] == (r["score"] >= 0.5) for r in held if r["doc_id"] in truth]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out)


def test_classifier_without_labels(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    out = classifier.scored(docs, spark.createDataFrame([], "doc_id bigint, quality int")).collect()
    assert {r["score"] for r in out} == {0.5}
    assert classifier.scored(frame(spark, []), spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")).count() == 0


@pytest.mark.parametrize("run", [jaccard.near_duplicates, substring.cut_passages, lambda d: decontaminate.leaks(d, d.selectExpr("doc_id AS item_id", "text"))])
def test_empty_tables(spark, run):
    assert run(frame(spark, [])).count() == 0
    assert run(frame(spark, [(1, None), (2, "")])).count() in (0, 2)
