"""Conversation structure repair by an auction algorithm for shortest paths.

Rows of a conversation, in order, are to become a chat of the form ``(system? (user assistant)+)?`` by the cheapest
edits: keep (0, where the role fits), give another role (3), delete (4), insert an empty turn (3); a row that ends
without ``.``, ``!`` or ``?`` costs 3 more unless it is deleted. Blank rows and repetitions of an earlier row must be deleted;
they never change what is best for the others, so they stay outside the lattice, whose nodes are (rows done, state of
the form) and whose arcs are edits.

Prices of the nodes start at a lower bound of the cost that is left. A path grows from a node along its cheapest
arc where the node's price allows it; else the price rises and the path loses its last node. When the path ends, the
prices along it are exact, and an arc of any cheapest repair is tight. The repair whose edits come first in ASCII
order is traced over tight arcs; the head of a tight arc gets its exact price by the same auction before the arc is
taken.

Rows are sorted by Spark's range exchange, so a conversation may lie over many tasks. Every 256 rows make a segment;
where a conversation has several, auctions give each segment's costs between the states at its two ends, and the costs
left at each border are summed backwards over segments. Only the last pass, which hashes the repaired text, follows a
conversation from its first row to its last, because such a hash is sequential; it holds one batch of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.tables import save

RETYPE, DELETE, INSERT, OPEN_END = 3, 4, 3, 3
#: 2 to this power rows make one lattice, so segments never cross the partitions of the range exchange.
SEGMENT_BITS = 8
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn. An inserted or renamed turn leads to WANT.
WANT, ROLES = (2, 2, 3, 2), {2: "user", 3: "assistant"}
REACH = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))
KEEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "x": {}}
#: What each state still costs after the last row: insertions up to the next accepted end.
TAIL = (0, 2, 1, 0)
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 40
SPACE = " \t\n\x0b\x0c\r"


class Lattice:
    """Edits of the rows in ``codes`` (s, u, a or x for another role, upper case for an open end); ``ends`` is the cost left at each state after them."""

    def __init__(self, codes: str, ends: tuple[int, ...]):
        self.codes, self.last = codes, 4 * len(codes)
        bound = [min(ends)]
        for c in reversed(codes):
            bound.append(bound[-1] + min(DELETE, RETYPE * (c in "xX") + OPEN_END * c.isupper()))
        live = [min(ends[e] for e in REACH[s]) < NEVER for s in range(4)]
        self.price = [b if live[s] else NEVER for b in reversed(bound) for s in range(4)]
        self.price[self.last :] = ends
        self.exact = bytearray(self.last) + b"\1\1\1\1"
        self.known: list[list | None] = [None] * self.last

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """(edit, next node, cost) in ASCII order of the edits."""
        out = self.known[node]
        if out is None:
            row, state = divmod(node, 4)
            code, after = self.codes[row], node - state + 4
            extra = OPEN_END if code.isupper() else 0
            out = [("D", after + state, DELETE), ("I", node - state + WANT[state], INSERT)]
            if (to := KEEPS[code.lower()].get(state)) is not None:
                out.append(("K", after + to, extra))
            out.append(("R", after + WANT[state], RETYPE + extra))
            self.known[node] = out
        return out

    def settle(self, origin: int) -> None:
        """The auction: afterwards the price of ``origin`` is exactly what is left to pay."""
        price, exact, path = self.price, self.exact, [origin]
        while not exact[node := path[-1]] and price[origin] < NEVER:
            least, to = min((cost + price[to], to) for _, to, cost in self.arcs(node))
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        for node in path if price[origin] < NEVER else ():
            exact[node] = 1

    def trace(self, state: int) -> tuple[str, int, int]:
        """From a state before the rows: the cheapest edits that come first, the state after them, and the whole cost."""
        node, edits = state, []
        self.settle(node)
        cost = self.price[node]
        while node < self.last:
            for edit, to, paid in self.arcs(node):
                if self.price[node] == paid + self.price[to]:
                    self.settle(to)
                    if self.price[node] == paid + self.price[to]:
                        edits.append(edit)
                        node = to
                        break
        return "".join(edits), node - self.last, cost


@lru_cache(maxsize=20_000)
def cheapest(codes: str, ends: tuple[int, ...], state: int) -> tuple[str, int, int]:
    return Lattice(codes, ends).trace(state)


@lru_cache(maxsize=20_000)
def crossing(codes: str) -> list[int]:
    """The 16 costs between the states before and after the rows (NEVER where there is no way), by the state before."""
    if not codes:
        return [0 if a == b else NEVER for a in range(4) for b in range(4)]
    out = [NEVER] * 16
    for after in range(4):
        lattice = Lattice(codes, tuple(0 if s == after else NEVER for s in range(4)))
        for before in range(4):
            lattice.settle(before)
            out[4 * before + after] = min(lattice.price[before], NEVER)
    return out


def judged(chats: DataFrame) -> DataFrame:
    """(conv, at, seg, conv_id, turn, role, text, copies, fresh, code): distinct rows in order, with how often each came.

    conv is a key without nulls; ``fresh`` rows are neither blank nor seen earlier, and code tells their place in the lattice ("" for
    rows to delete). ``at`` grows along each conversation.
    """
    rows = chats.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    rows = rows.groupBy(rows.columns).agg(F.count("*").alias("copies")).withColumn("digest", F.md5(F.col("text").cast("binary")))
    rows = save(rows.withColumn("core", F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.where("core <> ''").groupBy("conv", "role", "digest").agg(F.min(turn).alias("turn"))
    first = save(first.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("turn.turn").alias("t"), F.lit(True).alias("fresh")))
    same = (rows.conv == first.c) & (rows.role == first.r) & (rows.digest == first.d) & rows.turn.eqNullSafe(first.t)
    rows = rows.join(first, same, "left").drop("c", "r", "d", "t").withColumn("fresh", F.coalesce("fresh", F.lit(False)))
    initial = F.left("role", F.lit(1))
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(~F.col("core").isin(".", "!", "?"), F.upper(code)).otherwise(code)
    rows = save(rows.withColumn("code", F.when(F.col("fresh"), code).otherwise("")))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.left("text", F.lit(64)).asc(), F.col("digest")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return save(rows.withColumn("seg", F.shiftright("at", SEGMENT_BITS)).drop("digest"))


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = [crossing(codes) for codes in batch["codes"].to_pylist()]
        yield pa.RecordBatch.from_pydict({"conv": batch["conv"], "seg": batch["seg"], "costs": pa.array(costs, pa.list_(pa.int64()))})


def _costs_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a conversation from its last to its first: what is left to pay at each state after the segment."""
    of, left = None, ()
    for batch in batches:
        out = []
        for conv, costs in zip(batch["conv"].to_pylist(), batch["costs"].to_pylist(), strict=True):
            if conv != of:
                of, left = conv, tuple(INSERT * x for x in TAIL)
            out.append(left)
            left = tuple(min(costs[4 * s + e] + left[e] for e in range(4)) for s in range(4))
        yield pa.RecordBatch.from_pydict({"conv": batch["conv"], "seg": batch["seg"], "ends": pa.array(out, pa.list_(pa.int64()))})


def segments(rows: DataFrame) -> DataFrame:
    """(conv, seg, conv_id, codes, ends): the lattice rows of each segment, and the cost left at each state after it."""
    mark = F.array_sort(F.collect_list(F.struct("at", "code")))
    parts = save(rows.groupBy("conv", "seg").agg(F.first("conv_id").alias("conv_id"), F.array_join(F.transform(mark, lambda x: x["code"]), "").alias("codes")))
    several = save(parts.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1"))
    costs = parts.join(several, "conv", "left_semi").mapInArrow(_crossings, "conv string, seg bigint, costs array<bigint>")
    left = costs.repartition("conv").sortWithinPartitions("conv", F.desc("seg")).mapInArrow(_costs_left, "conv string, seg bigint, ends array<bigint>")
    default = F.array(*(F.lit(INSERT * x).cast("long") for x in TAIL))
    return parts.join(save(left), ["conv", "seg"], "left").withColumn("ends", F.coalesce("ends", default))


class _Chat:
    """One conversation while its rows pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.cost = conv_id, 0, None
        self.plan: Iterator[str] = iter("")
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.turns, self.low, self.high, self.turn = 0, 0, 0, None
        self.forced, self.before = 0, None
        self.audit: list[str] = []
        self.digest, self.lines = hashlib.sha256(), 0

    def segment(self, codes: str, ends: tuple[int, ...]) -> None:
        edits, _, cost = cheapest(codes, ends, self.state)
        self.plan = iter(edits)
        self.cost = cost if self.cost is None else self.cost

    def put(self, role: str, text: str) -> tuple[int | None, int, str, str]:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1
        return self.conv_id, self.lines, role, text

    def insert(self) -> tuple[int | None, int, str, str]:
        self.audit.append("I")
        self.state = WANT[self.state]
        return self.put(ROLES[self.state], "")

    def row(self, turn: int | None, role: str, text: str, copies: int, fresh: bool, code: str, core: str) -> Iterator[tuple]:
        if turn is not None and turn != self.turn:
            self.low = turn if self.turn is None else self.low
            self.high = self.turn = turn
            self.turns += 1
        pair = (self.before + role[:1]) if self.before is not None else "su"
        self.counts["illegal"] += copies - 1 + (pair not in LEGAL)
        self.before = role[:1]
        self.counts["blank" if not core else "duplicate"] += copies - fresh
        self.counts["truncated"] += fresh and code.isupper()
        if fresh:
            while (edit := next(self.plan)) == "I":
                yield self.insert()
            self.audit.append(edit)
            if edit == "K":
                self.state = KEEPS[code.lower()][self.state]
                yield self.put(role, text)
            elif edit == "R":
                self.state = WANT[self.state]
                yield self.put(ROLES[self.state], text)
        self.audit.append("D" * (copies - fresh))
        self.forced += copies - fresh

    def close(self) -> Iterator[tuple]:
        for _ in range(TAIL[self.state]):
            yield self.insert()

    def report(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *self.counts.values(), (self.cost or 0) + DELETE * self.forced, "".join(self.audit), self.digest.hexdigest()


REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
TURNS = "conv_id bigint, place bigint, role string, text string"
KINDS = {"bigint": pa.int64(), "string": pa.string()}


def _batch(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    names = [x.split() for x in kinds.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], KINDS[kind]) for i, (_, kind) in enumerate(names)], names=[n for n, _ in names])


def _pass(kinds: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, chat, turns = None, None, kinds == TURNS
        for batch in batches:
            out: list[tuple] = []
            for x in batch.to_pylist():
                if x["conv"] != of:
                    out += _ended(chat, turns)
                    of, chat = x["conv"], _Chat(x["conv_id"])
                if x["codes"] is not None:
                    chat.segment(x["codes"], tuple(x["ends"]))
                else:
                    made = chat.row(x["turn"], x["role"], x["text"], x["copies"], x["fresh"], x["code"], x["core"])
                    if turns:
                        out += made
                    else:
                        for _ in made:
                            pass
            yield _batch(out, kinds)
        yield _batch(_ended(chat, turns), kinds)

    return run


def _ended(chat: _Chat | None, turns: bool) -> list[tuple]:
    if chat is None:
        return []
    tail = list(chat.close())
    return tail if turns else [chat.report()]


def _followed(chats: DataFrame, kinds: str) -> DataFrame:
    rows = judged(chats)
    parts = segments(rows).withColumn("at", F.shiftleft("seg", SEGMENT_BITS)).drop("seg")
    both = rows.drop("seg").unionByName(parts, allowMissingColumns=True)
    both = both.repartition("conv").sortWithinPartitions("conv", "at", F.col("codes").isNull())
    return both.mapInArrow(_pass(kinds), kinds)


def report(chats: DataFrame) -> DataFrame:
    """One row per conversation: what is wrong with it, and the cheapest repair.

    Rows go by turn (nulls first), then role, then text (its first 64 characters, then its MD5); a null role or text is one
    space; rows without conv_id are one conversation of their own. gaps: turn numbers missing between the smallest and the
    largest. Each row counts by its first fault: blank (nothing but space), duplicate (role and text of an earlier row), truncated (no ``.``,
    ``!`` or ``?`` at its end). illegal: neighbours whose role initials are not su, ua or au. cost and audit: the cheapest edits, as
    the initials of Keep, Rerole, Delete and Insert; of equally cheap ones those first in ASCII order. repaired_sha256: lines
    ``role:text`` of the result. Other columns are ignored; an empty table gives no rows; the length of texts and conversations is not bounded.
    """
    return _followed(chats, REPORT)


def repaired(chats: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the turns of every repaired conversation, by the rules of ``report``; place counts from 1."""
    return _followed(chats, TURNS)
