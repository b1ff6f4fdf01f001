import random
import re
import textwrap

import brute
import duckdb
import pytest

import corpus_pipeline
from tallyforge.llm import chat, licenses, queries, rules, urls

TEXTS = [
    None, "", "  \n", "one", "a b " * 30, "x\ty\x0bz\x0cw\rv\n" * 5, "é ü ß " * 9, "#$ %& |<> ** word" * 4, "naïve\x1cnot\x85blank\u00a0here",
    " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i % 9}" for i in range(50)), "line one\nline one\n\nline two\nline one\n \n",
    " ".join(["p q r s t u v w"] * 2 + [f"z{i}" for i in range(40)]), " ".join(f"v{i}" for i in range(20_000)), "same " * 5000, "😀 smile " * 12,
]


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, words string, n_words int")


def test_statistics(spark):
    rows = list(enumerate(TEXTS))
    for r in rules.statistics(docs_of(spark, rows)).withColumn("failed", rules.base_failed()).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["failed"]) == brute.statistics(TEXTS[r["doc_id"]]), r


@pytest.mark.parametrize("seed", range(3))
def test_repeats_in_random_texts(spark, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("abc"[: 1 + i % 3]) for _ in range(rng.randrange(60)))) for i in range(120)]
    for r in rules.statistics(docs_of(spark, rows)).collect():
        assert r["n_repeat_words"] == brute.statistics(rows[r["doc_id"]][1])[4]


def labelled(seed, n=900):
    """Documents of which those full of symbols, and long ones in capitals, are bad."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(25, 90))]
        kind = i % 6
        if kind == 0:
            words = [w + "$$$" for w in words]
        if kind == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if kind < 2 else 1, None))
    return rows, labels


def test_rules_are_learned(spark):
    rows, labels = labelled(1)
    table = spark.createDataFrame(labels[:700] + [(None, 1, 0), (3, None, 0), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = rules.judged(docs_of(spark, rows + [(None, "a " * 40), (5000, None)]), table).collect()
    assert len(out) == len(rows) + 2
    wrong = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 900 and r["kept"] != bool(labels[r["doc_id"]][1])]
    assert not wrong
    assert {r["rejected_by"] for r in out} - {None, "base"}
    assert all(not r["kept"] for r in out if r["base_failed"])


def test_rules_of_one_kind_of_label(spark):
    rows, labels = labelled(2, 60)
    for quality in (0, 1):
        table = spark.createDataFrame([(d, quality) for d, *_ in labels], "doc_id bigint, quality int")
        assert all(r["kept"] != r["base_failed"] for r in rules.judged(docs_of(spark, rows), table).collect())
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    assert rules.judged(docs_of(spark, rows), empty).where("NOT kept").count() == 0
    assert rules.judged(docs_of(spark, []), empty).count() == 0


def test_kept_rows(spark):
    rows, labels = labelled(3, 600)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = rules.kept(docs_of(spark, rows + [(None, "a b c")]), table)
    assert out.columns == ["doc_id", "text", "words", "n_words"]
    assert {r["doc_id"] for r in out.collect()} == {d for d, q, _ in labels if q}


LICENSED = [
    None, "", "MIT License", "the mit license mit license", "cc by", "CC-BY", "cc\nby", "GNU General Public\nLicense and Apache License", "mit  licenses", "xmit license",
    "prose\nReleased under the MIT License.\nmore", "released under the MIT", "under mit license released the", "Licensed under CC BY-NC 4.0!", "licensed under the apache license version 2",
    "This work is licensed under the GNU General Public License", "x\u00e9mit license", "mit\x1flicense", "MİT License", "license " * 50, "\n".join(["Released under the MIT License."] * 3),
]


def fill(text, width, mark=""):
    return textwrap.fill(text, width, initial_indent=mark, subsequent_indent=mark)


def license_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = con.sql(licenses.oracle())
    return {tuple(r) for r in got.fetchall()}, got.columns


def test_licenses(spark):
    rows = list(enumerate(LICENSED))
    got = licenses.scan(docs_of(spark, rows)).drop("blocks")
    want, columns = license_sql(rows)
    assert got.columns == columns
    assert {tuple(r) for r in got.collect()} == want
    by = {r[0]: r for r in want}
    assert by[3][2:7] == (2, 1, 3, "mit", "mit") and by[2][7] == 0.0 and by[10][7] == 1.0 and by[11][6] == "mit" and by[6][5] == "cc-by"


def test_license_edges(spark):
    assert licenses.scan(docs_of(spark, [])).count() == 0
    out = licenses.scan(docs_of(spark, [(None, "mit license"), (1, "x"), (1, "Released under the MIT License.")])).collect()
    assert len(out) == 3 and {r["base_labels"] for r in out if r["doc_id"] is None} == {"mit"}


def plain_licenses(text):
    """Method labels and best share by sets: every line, and every window of a template's width over all words."""
    split = lambda t: [x for x in re.split(licenses.BETWEEN, t.translate(brute.LOWER)) if x]
    words, labels, best = split(text), set(), 0.0
    for label, body in licenses.TEMPLATES:
        want = split(body)
        own, width = set(want), len(want)
        blocks = [split(x) for x in text.split("\n")] + [words[i : i + width] for i in range(max(1, len(words) - width + 1))]
        share = max(len(own & set(b)) / len(own) for b in blocks)
        if share >= licenses.THRESHOLD - 1e-9:
            labels.add(label)
            best = max(best, share)
    return labels, best


def test_licenses_over_lines(spark):
    rng = random.Random(4)
    bodies = [body for _, body in licenses.TEMPLATES]
    vocabulary = " ".join(bodies).replace(",", "").split()
    texts = [fill(body, 72, mark) for body in bodies for mark in ("", " * ", "REM ")] + [fill(body, 20) for body in bodies]
    texts = [f"some prose before\n\n{t}\nprose after it" for t in texts]
    texts += [" ".join(f"p{i}" for i in range(n)) + "\n" + "\r\n".join(body.split()) + "\n" + "word " * n for n in (0, 3, 50, 2000) for body in bodies]
    texts += [fill(" ".join(b for i in rng.sample(range(len(bodies)), 3) for b in bodies[i].split() if rng.random() > 0.15), 40) for _ in range(60)]
    texts += [fill(" ".join(rng.choice(vocabulary) for _ in range(400)), 60) for _ in range(10)]
    scattered = " filler\n" * 50
    texts += [scattered.join(bodies[8].split()), scattered.join(bodies[4].split())]
    got = {r["doc_id"]: r for r in licenses.scan(docs_of(spark, list(enumerate(texts))), phrases={"no such phrase": "none"}).collect()}
    for i, text in enumerate(texts):
        labels, best = plain_licenses(text)
        assert set(filter(None, got[i]["labels"].split(","))) == labels and got[i]["score"] == pytest.approx(best), (i, text)
    for i in range(27):
        assert licenses.TEMPLATES[i // 3][0] in got[i]["labels"].split(",")
    assert not got[len(texts) - 1]["labels"] and not got[len(texts) - 2]["labels"]


URLS = [
    None, "", "no scheme", "http://", "://", "http://a.com", "http://a.com/", "HTTP://WWW.Example.COM/en/x", "https://example.com/en", "https://example.com/en/", "https://sub.example.com/en/1?x=/en/",
    "https://notexample.com/en/1", "ftp://a.net/es/1", "ftp://a.net/fr/1#f", "ftp://anet/es/1", "http://net/es/", "http://a.org/p?q=http://b.com/", "http://a.com:80/x", "http://É.com/é", "a://b://c.com/d",
    "http://www.example.com/en/", "http://www.example.com/EN/", "http://deep.www.example.com/en/z", "http://x.org#com/", "http://x.org?com/",
]


def test_urls(spark):
    rows = list(enumerate(URLS)) + [(None, "http://a.com/"), (7, "http://b.org/x")]
    table = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id bigint, url string, host string, rule string")
    out = urls.judged(table).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule, verdict = brute.url_parts(r["url"], urls.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or (verdict is None and r["verdict"] in ("allow", "block"))
        assert (r["score"] is None) == (not host and not path)


def markov(texts, order):
    """Witten-Bell by recursion over plain counts."""
    from collections import Counter

    grams = Counter(t[max(0, i - k + 1) : i + 1] for t in texts for i in range(order - 1, len(t)) for k in range(1, order + 1))
    after = {}
    for g, c in grams.items():
        after.setdefault(g[:-1], {})[g[-1]] = c

    def chance(context, x):
        shorter = chance(context[1:], x) if context else 1 / urls.ALPHABET
        seen = after.get(context, {})
        total = sum(seen.values()) + len(seen)
        return (seen.get(x, 0) + len(seen) * shorter) / total if total else shorter

    return chance


def test_url_scores_against_plain_models(spark):
    import math
    import zlib

    rng = random.Random(2)
    rows = []
    for i in range(300):
        word = "".join(rng.choice("abcde") for _ in range(6))
        rows.append((i, f"http://{word}.example.com/en/{i}" if i % 3 == 0 else f"http://{word.replace('a', 'z')}.shop.com/p/{i}" if i % 3 == 1 else f"http://{word}.org/{rng.choice(['en', 'p'])}/{i}"))
    table = spark.createDataFrame(rows, "page_id bigint, url string")
    out = urls.judged(table).collect()
    texts = {}
    for i, u in rows:
        host, path, _, verdict = brute.url_parts(u, urls.RULES)
        held = zlib.crc32((host + path).encode()) % urls.HELD_OUT == 0
        texts[i] = (urls.START * (urls.ORDER - 1) + host + path + urls.END, None if held else verdict)
    good, bad = (markov([t for t, v in texts.values() if v == kind], urls.ORDER) for kind in ("allow", "block"))
    for r in out:
        t = texts[r["page_id"]][0]
        steps = [math.log(good(t[i - urls.ORDER + 1 : i], t[i])) - math.log(bad(t[i - urls.ORDER + 1 : i], t[i])) for i in range(urls.ORDER - 1, len(t))]
        assert r["score"] == pytest.approx(sum(steps) / len(steps), abs=1e-6)


def test_urls_of_empty_tables(spark):
    assert urls.judged(spark.createDataFrame([], "page_id bigint, url string")).count() == 0
    out = urls.judged(spark.createDataFrame([(1, "http://x.org/a"), (2, None)], "page_id bigint, url string")).collect()
    assert {r["page_id"]: r["verdict"] for r in out} == {1: "allow", 2: "block"}


def test_chats(spark):
    rng = random.Random(3)
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, None, None, None), (5, 0, "user", "<|im_end|>")]
    rows += [(None, 0, "user", "hi"), (1, 0, "user", "hi"), (6, 5, "user", "hi"), (6, 5, "assistant", "hi"), (7, 0, "userh", "i")]
    base = [("user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(12)]
    for c in range(10, 90):
        n = rng.randrange(1, 13)
        for i, (role, text) in enumerate(base[:n]):
            rows.append((c, i, role, text if rng.random() > 0.05 else "other"))
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, n string")
    assert {tuple(r) for r in chat.rendered(table).collect()} == brute.chats(rows)
    assert chat.rendered(table.limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES) - 1))
def test_stages_keep_columns(spark, sf_dir, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = docs.limit(60).selectExpr("*", "1 AS path", "'k' AS component").union(docs.limit(1).selectExpr("NULL", "NULL", "NULL", "NULL", "NULL", "1", "'k'"))
    assert corpus_pipeline.STAGES[stage][1](spark, extra, sf_dir).columns == extra.columns


def test_pipeline(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = [r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()]
    verdicts = {r["doc_id"]: r["kept"] for r in queries.op4_quality_rules(spark, sf_dir).collect()}
    left = [(d, t) for d, t in docs.items() if verdicts[d]]
    first = {d for d, _, c in brute.near_duplicates(left) if d == c}
    left = [(d, t) for d, t in left if d in first]
    gone = {d: n for d, _, n, _ in brute.cut_passages(left)}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    cut = dict(left)
    tokens = brute.tokenizer()
    whole = {d for d in cut if not gone[d]}
    leaked = {d for d, *_ in brute.leaks([(d, cut[d]) for d in whole], items)}
    got = {r["doc_id"]: r for r in rows}
    assert whole - leaked == set(got) & whole and set(got) <= set(cut)
    for d in whole & set(got):
        assert got[d]["n_tokens"] == len(tokens.encode_ordinary(cut[d])) and got[d]["decoded_sha256"] == brute.sha(cut[d].encode())
