import random

import brute
import pytest

from tallyforge.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit int"


def made(seed, chats, longest, names=("system", "user", "assistant", "tool", "unknown", "", None)):
    pick = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "open", "open end ", "", " \n", None, "Fine.\n\n", "a", "b", "c.", "d.", "e.", "ü.", "."]
    rows = []
    for conv in range(chats):
        for turn in range(pick.randint(1, longest)):
            rows.append((conv, pick.choice([turn, turn, turn + 2, None, 1]), pick.choice(names), pick.choice(texts) if pick.random() < 0.5 else f"t{pick.randint(0, 99)}."))
    return rows


def report_of(df):
    return {r["conv_id"]: tuple(r[1:]) for r in df.collect()}


def wanted(rows):
    return {c: (*x[:7], brute.sha("\n".join(f"{r}:{t}" for r, t in x[7]).encode())) for c, x in brute.repairs(rows).items()}


@pytest.mark.parametrize("seed", range(3))
def test_lattice_gives_least_cost_and_first_audit(seed):
    pick = random.Random(seed)
    for _ in range(400):
        codes = "".join(pick.choice("suaxSUAX" if pick.random() < 0.5 else "ua") for _ in range(pick.randint(0, 14)))
        rows = [({"s": "system", "u": "user", "a": "assistant", "x": "tool"}[c.lower()], "t", False, c.isupper()) for c in codes]
        edits, state, cost = repair.cheapest(codes, tuple(repair.INSERT * x for x in repair.TAIL), 0)
        want = brute._edits(rows)
        assert (cost, edits + "I" * repair.TAIL[state]) == want[:2], codes


def test_costs_over_segments_add_up():
    pick = random.Random(5)
    for _ in range(200):
        codes = "".join(pick.choice("suaxSUAX") for _ in range(pick.randint(0, 12)))
        cut = pick.randint(0, len(codes))
        ends = tuple(repair.INSERT * x for x in repair.TAIL)
        one, two = repair.crossing(codes[:cut]), repair.crossing(codes[cut:])
        left = tuple(min(two[4 * s + e] + ends[e] for e in range(4)) for s in range(4))
        assert min(one[e] + left[e] for e in range(4)) == repair.cheapest(codes, ends, 0)[2]
        first, state, cost = repair.cheapest(codes[:cut], left, 0)
        second, _, _ = repair.cheapest(codes[cut:], ends, state)
        assert (first + second, cost) == (repair.cheapest(codes, ends, 0)[0], repair.cheapest(codes, ends, 0)[2])


def test_report_against_plain_python(spark, monkeypatch):
    rows = made(1, 60, 14) + [(None, 0, "user", "no id."), (None, 1, "assistant", "Yes.")] + [(77, t % 50, "user", "again and again.") for t in range(300)]
    rows += [(78, t, ("user", "assistant")[t % 2 if t % 7 else 0], f"turn {t}{'.' if t % 5 else ''}") for t in range(900)] + [(79, None, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert report_of(repair.report(df)) == wanted(rows)
    monkeypatch.setattr(repair, "SEGMENT_BITS", 3)
    assert report_of(repair.report(df.repartition(5))) == wanted(rows)


def test_repaired_turns(spark):
    rows = made(2, 40, 9)
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = {}
    for conv, _, role, text in sorted(map(tuple, repair.repaired(df).collect()), key=lambda x: x[:2]):
        got.setdefault(conv, []).append((role, text))
    assert got == {c: x[7] for c, x in brute.repairs(rows).items() if x[7]}


def test_empty_table_and_long_texts(spark):
    assert repair.report(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, 0, "user", "long words " * 200_000 + "?"), (1, 1, "assistant", " " * 500_000), (1, 2, "assistant", "x" * 1_000_000)]
    assert report_of(repair.report(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA))) == wanted(rows)


def test_query_damages_and_repairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = wanted(brute.damaged(rows))
    none = (0, 0, 0, 0, 0, 0, "", brute.sha(b""))
    assert report_of(queries.op13_conversation_repair(spark, sf_dir)) == {r[0]: want.get(r[0], none) for r in rows}


def test_damage(spark):
    rows = made(3, 50, 8) + [(None, 3, "user", "x."), (1, None, None, None)]
    got = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    key = lambda r: tuple((v is None, v) if not isinstance(v, str) else (False, v) for v in r)
    got = sorted((tuple(r) for r in queries.damaged(got).collect()), key=lambda r: str(key(r)))
    assert got == sorted(brute.damaged(rows), key=lambda r: str(key(r)))
