"""Quality rules: fixed ones, and an ordered list of rules learned from labelled documents.

Statistics of whole texts are one projection of SQL functions. A rule is a conjunction of thresholds on them;
sequential covering grows it condition by condition on two thirds of the labelled rows by information gain,
prunes it on the other third, keeps it if it is precise there, takes away what it covers, and goes on. Every step
is one aggregate over the labelled statistics whose result has a row for each feature, bin, label and
fold; the result is an ordered conditional expression of Spark columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.tables import join_texts, plain_ids, row_keyed, save

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
RUN = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Learner:
    """Bounds of the search; none of them limits the rows."""

    bins: int = 24
    max_rules: int = 12
    max_conditions: int = 4
    min_precision: float = 0.9
    min_covered: int = 5


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def _run_starts(hashes: Column) -> Column:
    """Places, ascending, of the elements that occur twice or more."""

    def repeated(pairs: Column) -> Column:
        same = F.filter(pairs, lambda e, i: (e["h"] == F.get(pairs, i - 1)["h"]) | (e["h"] == F.get(pairs, i + 1)["h"]))
        return F.array_sort(F.transform(same, lambda e: e["i"]))

    return _let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)


def _covered(starts: Column, size: int) -> Column:
    """Number of places within ``size`` of the ascending starts."""

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return _let(starts, total)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_marks) per row.

    Words are runs of characters other than space and \\t \\n \\v \\f \\r. n_repeat_words counts the words in windows of
    eight words that occur twice or more in the text; windows are told apart by 64-bit hashes. Null texts
    are empty. Rows stay as they are: null and repeated ids too.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.array_remove(F.split(text, BLANK), "").alias("words"))
    n = F.size("words")
    runs = F.when(n >= RUN, F.transform(F.sequence(F.lit(1), n - (RUN - 1)), lambda i: F.xxhash64(F.slice("words", i, RUN)))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    size = {"word_chars": F.length(F.array_join("words", ""))}
    size |= {k: F.length(F.regexp_replace("text", p, "")) for k, p in (("n_symbols", SYMBOLS), ("n_capitals", "[^A-Z]+"), ("n_marks", "[^!?]+"))}
    made = base.select("doc_id", n.alias("n_words"), *[v.alias(k) for k, v in size.items()], lines.alias("lines"), runs.alias("runs"))
    repeats = F.when(F.size(F.array_distinct("runs")) < F.size("runs"), _covered(_run_starts(F.col("runs")), RUN)).otherwise(0)
    dups = F.size("lines") - F.size(F.array_distinct("lines"))
    made = made.withColumns({"n_dup_lines": dups, "n_repeat_words": repeats, "n_lines": F.size("lines")})
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks"]
    return made.select("doc_id", *[F.col(c).cast("long").alias(c) for c in names])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def features() -> dict[str, Column]:
    """What conditions test; 0 where there is nothing to divide by."""

    def per(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    return {
        "words": F.col("n_words").cast("double"),
        "chars_per_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "capitals_per_char": per("n_capitals", "word_chars"),
        "marks_per_word": per("n_marks", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
    }


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """Cuts midway between quantiles of each feature, of the bad rows and of the good ones, these closer at their ends."""
    ends = (0.0, 0.001, 0.005, 0.01, 0.05)
    at = {True: [i / bins for i in range(bins + 1)], False: [*ends, 0.25, 0.5, 0.75, *(1 - e for e in reversed(ends))]}
    wanted = {f"{k}_{bad}": F.percentile_approx(F.when(F.col("bad") == bad, col), at[bad], 10_000) for k, col in features().items() for bad in at}
    found = rows.agg(*[v.alias(k) for k, v in wanted.items()]).first().asDict()
    values = {k: sorted({*(found[f"{k}_True"] or []), *(found[f"{k}_False"] or [])}) for k in features()}
    return {k: [(a + b) / 2 for a, b in pairwise(v)] for k, v in values.items()}


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts the value reaches."""
    return _let(value, lambda x: F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: t <= x)))


class _Counts:
    """Good and bad rows of each fold by feature and bin, from one aggregate."""

    def __init__(self, rows: DataFrame, names: list[str], cuts: dict[str, list[float]]):
        cells = rows.select("bad", "prune", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin", "bad", "prune").count().collect()
        self.cells = {(names[r["feature"]], r["bin"], r["bad"], r["prune"]): r["count"] for r in cells}
        self.names, self.cuts = names, cuts

    def of(self, feature: str, bins: range, prune: bool) -> tuple[int, int]:
        """(bad, good)"""
        return tuple(sum(self.cells.get((feature, b, bad, prune), 0) for b in bins) for bad in (True, False))

    def all(self, prune: bool) -> tuple[int, int]:
        return self.of(self.names[0], range(len(self.cuts[self.names[0]]) + 1), prune)

    def best(self, least: int) -> tuple[float, Condition, tuple[int, int]] | None:
        """The condition of the highest information gain; ties go to the first feature and threshold."""
        p0, n0 = self.all(False)
        found = None
        for name in self.names:
            cuts = self.cuts[name]
            for i, cut in enumerate(cuts):
                for above, bins in ((True, range(i + 1, len(cuts) + 1)), (False, range(i + 1))):
                    p, n = self.of(name, bins, False)
                    if p < least:
                        continue
                    gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    if found is None or gain > found[0] + 1e-9:
                        found = (gain, Condition(name, above, cut), self.of(name, bins, True))
        return found


def learn(rows: DataFrame, learner: Learner | None = None) -> list[Rule]:
    """Ordered rules that name bad documents, from statistics with a boolean column ``bad``.

    Without bad or without good rows there are no rules. Folds depend on doc_id, so the rules do not depend
    on the order or partitions of the rows.
    """
    learner = learner or Learner()
    cuts = _thresholds(rows, learner.bins)
    names = [k for k in features() if cuts[k]]
    if not names:
        return []
    fold = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune")
    left = save(rows.select("*", fold, F.array(*[_bin(features()[k], cuts[k]) for k in names]).alias("bins")))
    rules: list[Rule] = []
    while len(rules) < learner.max_rules:
        covered, rule, pruned = left, [], []
        while len(rule) < learner.max_conditions:
            counts = _Counts(covered, names, cuts)
            if not min(counts.all(False)):
                break
            best = counts.best(learner.min_covered)
            if best is None or best[0] <= 0:
                break
            rule.append(best[1])
            pruned.append(best[2])
            covered = covered.where(best[1].column())
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in pruned]
        if not worth:
            break
        size = worth.index(max(worth)) + 1
        p, n = pruned[size - 1]
        if p / (p + n + 1) < learner.min_precision:  # one good row more than was seen
            break
        rules.append(tuple(rule[:size]))
        left = left.where(~_holds(rules[-1]))
    return rules


def _holds(rule: Rule) -> Column:
    out = rule[0].column()
    for condition in rule[1:]:
        out = out & condition.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects a row of statistics, null if none does."""
    out = F.when(base_failed(), "base")
    for rule in rules:
        out = out.when(_holds(rule), " and ".join(map(str, rule)))
    return out


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", learner: Learner | None = None) -> DataFrame:
    """Statistics with base_failed, rejected_by and kept for every row of ``docs``.

    ``labels`` has doc_id and quality (0: bad); rows with nulls are left out, and of contradicting ones the lower counts.
    Rules are learned from labelled rows that pass the base rules. An empty table gives an empty result.
    """
    stats = save(statistics(docs, id_col, text_col))
    return _with_verdicts(stats, _learned(stats, labels, learner))


def _learned(stats: DataFrame, labels: DataFrame, learner: Learner | None) -> list[Rule]:
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") == 0).alias("bad"))
    return learn(stats.join(known, "doc_id").where(~base_failed()), learner)


def _with_verdicts(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    out = stats.withColumn("base_failed", base_failed()).withColumn("rejected_by", verdict(rules))
    return out.withColumn("kept", F.col("rejected_by").isNull())


def kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", learner: Learner | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept; columns as they came.

    Every row is judged by its own text, also where ids are null or repeated.
    """
    if not plain_ids(docs, id_col):
        rules = _learned(save(statistics(docs, id_col, text_col)), labels, learner)
        rows, once = row_keyed(docs, id_col, text_col)
        bad = save(_with_verdicts(statistics(once), rules).where("NOT kept").select(F.col("doc_id").alias("_row")))
        return rows.join(bad, "_row", "left_anti").select(docs.columns)
    bad = save(judged(docs, labels, id_col, text_col, learner).where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct())
    return join_texts(docs, bad, id_col, "left_anti").select(docs.columns)
