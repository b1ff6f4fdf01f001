"""URL filter: rules first, and a ratio of two character language models for the rest.

The URLs that a rule allows and those that one blocks train a Markov model each. A character's probability
mixes all orders up to ORDER, weighting each by how often its context was seen against how many different
characters followed it (Witten-Bell), down to a uniform one. Counts are aggregates over the ruled URLs that are not
held out (one in HELD_OUT is, by hash), and every model
step is a join of count tables. A URL's score is the mean over its characters of the log ratio of the two models; the cut
is the score that separates held-out URLs of both kinds best.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.tables import save

ORDER = 5
ALPHABET = 256
SCALE = 10**9
HELD_OUT = 5
#: (verdict, host and path prefix)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
START, END = "\u0002", "\u0003"


def _parts(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _ruled(rules, out: int) -> Column:
    """Name (1) or verdict (0) of the longest rule that fits; of equal ones the first by name."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        host, _, path = rule[1].partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(f"/{path}"))
        found = F.when(fits, rule[out]).otherwise(found)
    return found


def _model(grams: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log ratio of the last character of every gram of ``order`` characters given those before it."""
    lower = None
    for k in range(1, order + 1):
        tail = grams.groupBy(F.right("gram", F.lit(k)).alias("gram")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        tail = tail.withColumn("context", F.substring("gram", 1, k - 1))
        seen = {f"{kind}_n": F.sum(kind) for kind in ("good", "bad")} | {f"{kind}_t": F.count_if(F.col(kind) > 0) for kind in ("good", "bad")}
        level = tail.join(tail.groupBy("context").agg(*[v.alias(c) for c, v in seen.items()]), "context")
        if lower is None:
            level = level.withColumns({f"{kind}_q": F.lit(1.0 / ALPHABET) for kind in ("good", "bad")})
        else:
            level = level.withColumn("shorter", F.right("gram", F.lit(k - 1))).join(lower, "shorter")
        mixed = {}
        for kind in ("good", "bad"):
            total = F.col(f"{kind}_n") + F.col(f"{kind}_t")
            mixed[f"{kind}_p"] = F.when(total > 0, (F.col(kind) + F.col(f"{kind}_t") * F.col(f"{kind}_q")) / total).otherwise(F.col(f"{kind}_q"))
        level = level.withColumns(mixed)
        lower = save(level.select(F.col("gram").alias("shorter"), F.col("good_p").alias("good_q"), F.col("bad_p").alias("bad_q")))
    return lower.select(F.col("shorter").alias("gram"), (F.log("good_q") - F.log("bad_q")).alias("ratio"))


def _cut(scored: DataFrame) -> float:
    """The score, to two digits, from which the shares of good above and bad below are largest together."""
    bins = scored.groupBy(F.round(F.greatest(F.least("score", F.lit(9.0)), F.lit(-9.0)), 2).alias("bin"), "allowed").count().collect()
    total = {kind: sum(r["count"] for r in bins if r["allowed"] == kind) for kind in (True, False)}
    if not all(total.values()):
        return 0.0
    best = None
    for cut in sorted({r["bin"] for r in bins} | {0.0}):
        rate = sum(r["count"] / total[r["allowed"]] for r in bins if r["allowed"] == (r["bin"] >= cut))
        if best is None or (rate, -abs(cut)) > best[0]:
            best = ((rate, -abs(cut)), cut)
    return best[1] - 0.005


def judged(pages: DataFrame, rules=RULES, url_col: str = "url", order: int = ORDER) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (replacing columns of these names).

    The longest fitting rule decides; else the models do: allow from the calibrated cut on. A null url or one
    without :// has empty host and path, no score, and is blocked. Without URLs of both kinds the cut is 0. The
    models count every distinct ruled host and path that is not held out once, so repeated rows change nothing;
    held-out ones are not counted after the calibration either.
    """
    made = ("host", "path", "rule", "verdict", "score")
    host, path = _parts(F.coalesce(F.col(url_col), F.lit("")))
    parsed = pages.select(*[c for c in pages.columns if c not in made], host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("rule", _ruled(rules, 1)).withColumn("verdict", _ruled(rules, 0))
    key = [F.xxhash64("host", "path").alias("k1"), F.hash("path", "host").alias("k2")]
    texts = parsed.where("host <> '' OR path <> ''").select("host", "path", (F.col("verdict") == "allow").alias("allowed")).distinct()
    texts = texts.withColumn("held", F.pmod(F.crc32(F.concat("host", "path").cast("binary")), F.lit(HELD_OUT)) == 0)
    texts = save(texts.select(*key, F.concat(F.lit(START * (order - 1)), "host", "path", F.lit(END)).alias("text"), "allowed", "held"))
    grams = texts.select("k1", "k2", "allowed", "held", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") - (order - 1)), lambda i: F.substr("text", i, F.lit(order)))).alias("gram"))
    trains = ~F.col("held")
    counts = grams.groupBy("gram").agg(F.count_if(trains & F.col("allowed")).alias("good"), F.count_if(trains & ~F.col("allowed")).alias("bad"))
    model = _model(save(counts), order)
    points = grams.select("k1", "k2", "allowed", "held", "gram").join(model, "gram")
    mean = F.sum(F.round(F.col("ratio") * SCALE).cast("long")) / F.count("*") / SCALE
    scored = save(points.groupBy("k1", "k2").agg(F.first("allowed").alias("allowed"), F.first("held").alias("held"), mean.alias("score")))
    cut = _cut(scored.where("held AND allowed IS NOT NULL"))
    marks = [f"k{i}" + "_" * max(map(len, pages.columns)) for i in (1, 2)]  # longer than any name in pages
    out = parsed.withColumns({marks[0]: F.xxhash64("host", "path"), marks[1]: F.hash("path", "host")})
    out = out.join(scored.select("k1", "k2", "score").toDF(*marks, "score"), marks, "left").drop(*marks)
    return out.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= cut, "allow").otherwise("block")))
