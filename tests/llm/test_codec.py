"""The pair check by undone merges against the merges themselves."""

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import bpe, queries, tokencount


@pytest.fixture(scope="module")
def codec():
    with open(queries.RANKS, "rb") as f:
        return bpe.codec_of(f.read(), queries.PATTERN)


def test_pairs_stay_apart_as_the_merges_say(codec):
    pick = random.Random(1)
    every = sorted(codec.bytes)
    frequent = [codec.ranks[x] for x in (b"e", b"t", b"th", b"the", b" t", b" the", b"in", b"ing", b"er", b"  ", b"    ", b"==", b"aa", b"a", b"\n") if x in codec.ranks]
    for k in range(60_000):
        left, right = (pick.choice(frequent if (k + j) % 3 == 0 else every) for j in (0, 1))
        assert codec.apart(left, right) == (codec.merged(codec.bytes[left] + codec.bytes[right]) == [left, right]), (left, right)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=2, max_size=5), min_size=1, max_size=14, unique=True), st.text("ab", max_size=40))
def test_small_vocabularies(tokens, text):
    ranks = {b"a": 0, b"b": 1}
    for t in tokens:
        ranks.setdefault(t.encode(), len(ranks))
    small = bpe.Codec(ranks, "[ab]+")
    for left in small.bytes:
        for right in small.bytes:
            assert small.apart(left, right) == (small.merged(small.bytes[left] + small.bytes[right]) == [left, right])
    if text and text.encode() not in ranks and not small.unordered and all(small.merged(b) == [i] for b, i in ranks.items()):
        assert small.ids(text.encode()) == small.merged(text.encode())


def test_generations_change_nothing(codec, monkeypatch):
    texts = [" ".join(random.Random(i).choices(["other", "words", "wörter", "x1", "....", "ab" * 9], k=40)) for i in range(30)]
    want = [brute.tokenizer().encode_ordinary(t) for t in texts]
    monkeypatch.setattr(bpe, "KEPT_PIECES", 6)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 4)
    small = bpe.Codec(codec.ranks, queries.PATTERN)
    assert [np.frombuffer(small.encode(t), "<u4").tolist() for t in texts] == want
    assert len(small) <= 3 and len(small.old) <= 3 and len(small.pairs) <= 2


def test_trees_made_in_the_pass_that_edits(spark):
    rows = [(i, "Some words, and more of them. " * i if i else None) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("edits", queries.made_edits())
    built = tokencount.build(df, queries.RANKS, queries.PATTERN)
    one, two = (tokencount.apply_edits(x, queries.RANKS, queries.PATTERN) for x in (df, built))
    columns = ["doc_id", "text", "tree", "n_tokens", "n_before", "n_recounted"]
    assert sorted(map(str, one.select(columns).collect())) == sorted(map(str, two.select(columns).collect()))


def test_leaves_grow_before_the_tree_does(codec):
    text = "one two three four " * 100
    tree = tokencount.build_tree(text, codec)
    size = tree.size
    for k in range(40):
        text, _ = tokencount.edit(text, tree, 37 * k, 0, "new words here ", codec)
        assert tree.tokens == len(codec.encode(text)) // 4 and tree.chars[1] == len(text)
    assert tree.size <= 2 * size
