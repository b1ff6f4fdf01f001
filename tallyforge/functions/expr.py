"""Column expressions shared by all operators.

Everything here stays inside the JVM. Arithmetic is safe under ANSI mode: a zero divisor or a
failed cast gives NULL, not an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, Any]


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify(rules: Iterable[Rule], default: Any = None) -> Column:
    """First matching rule wins; a NULL predicate does not match."""
    rules = list(rules)
    head, *tail = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], rule[1]), tail, F.when(head[0], head[1]))
    return chain.otherwise(default)


def band(
    value: Column | str, steps: Sequence[tuple[float, Any]], default: Any, below: bool = False, closed: bool = False
) -> Column:
    """Threshold bands, tested in the given order.

    ``value >= threshold`` picks the label; with ``below`` the test is ``value < threshold``
    (``<=`` when also ``closed``). NULL gets ``default``.
    """
    v = as_col(value)

    def hit(threshold: float) -> Column:
        if not below:
            return v >= threshold
        return v <= threshold if closed else v < threshold

    return classify([(hit(threshold), label) for threshold, label in steps], default)


def score_map(value: Column | str, scores: Mapping[Any, Any], default: Any) -> Column:
    """Look a value up in a small fixed mapping."""
    v = as_col(value)
    return classify([(v == key, score) for key, score in scores.items()], default)


def member_label(value: Column | str, groups: Mapping[str, Sequence[Any]], default: Any) -> Column:
    """Label by set membership: ``{label: [members]}``."""
    v = as_col(value)
    return classify([(v.isin(list(members)), label) for label, members in groups.items()], default)


def weighted_score(parts: Iterable[tuple[Column | str, float, Any]], digits: int | None = None) -> Column:
    """Sum of ``weight * value``; each part is ``(value, weight, value used for NULL or None to keep NULL)``."""

    def term(value: Column | str, weight: float, missing: Any) -> Column:
        v = as_col(value)
        return (v if missing is None else F.coalesce(v, F.lit(missing))) * F.lit(weight)

    total = reduce(lambda a, b: a + b, [term(*p) for p in parts])
    return total if digits is None else F.round(total, digits)


def settled_round(value: Column, digits: int) -> Column:
    """Round half away from zero; a value within 5e-11 of a rounding boundary counts as on it.

    A distributed floating sum depends on the order in which partitions are merged; with the
    margin, a result that lies on a boundary does not. Plain arithmetic, because ``round`` goes
    through a decimal object per row.
    """
    x, scale = value.cast("double"), float(10**digits)
    units = F.floor(F.abs(x) * scale + (0.5 + 5e-11 * scale))
    # beyond 2^53 a double has no fraction left at this scale, and floor would leave the range of a long
    # + 0.0 turns a negative zero into zero
    return F.when(F.abs(x) * scale < float(2**53), F.signum(x) * units / scale + 0.0).otherwise(F.round(x, digits))


def pct(part: Column, whole: Column, digits: int | None = None) -> Column:
    share = F.try_divide(part.cast("double") * 100.0, whole.cast("double"))
    return share if digits is None else settled_round(share, digits)


def share_where(condition: Column, digits: int | None = None) -> Column:
    """Aggregate: percentage of rows that satisfy ``condition`` (NULL counts as not satisfied)."""
    return pct(F.count_if(condition), F.count(F.lit(1)), digits)


def varies(value: Column | str) -> Column:
    """Aggregate: whether a column holds at least two different values.

    The moments of a constant column need not be exactly zero: merging partial results may move
    the mean by the last digit, and dividing by the resulting "deviation" gives noise.
    """
    v = as_col(value)
    return F.min(v) < F.max(v)


def spread(value: Column | str) -> Column:
    """Aggregate: sample standard deviation, exactly 0 for a constant column, NULL below two values."""
    v = as_col(value)
    return F.when(varies(v), F.stddev(v)).when(F.count(v) > 1, F.lit(0.0))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Aggregate: Pearson correlation over rows where both values are present.

    NULL for fewer than two such rows or zero variance, where ``corr`` raises under ANSI mode.
    """
    x, y = as_col(x).cast("double"), as_col(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(px) * F.stddev_pop(py))
    return F.when(varies(px) & varies(py), r)


def slope(y: Column | str, x: Column | str) -> Column:
    """Aggregate: least-squares slope of ``y`` on ``x``; NULL when ``x`` does not vary."""
    x, y = as_col(x).cast("double"), as_col(y).cast("double")
    px = F.when(y.isNotNull(), x)
    return F.when(varies(px), F.try_divide(F.covar_pop(x, y), F.var_pop(px)))


def z_score(value: Column | str, mean: Column | str, sd: Column | str) -> Column:
    return F.try_divide(as_col(value) - as_col(mean), as_col(sd))


def outside(z: Column, limit: float) -> Column:
    """True where ``|z| > limit``; an unknown z is not an outlier."""
    return F.coalesce(F.abs(z) > limit, F.lit(False))


def margin_of_error(sd: Column, n: Column, z: float = 1.96) -> Column:
    return F.try_divide(sd * z, F.sqrt(n.cast("double")))


def row_stddev(values: Sequence[Column | str]) -> Column:
    """Sample standard deviation across a fixed list of columns of one row."""
    cols = [as_col(v).cast("double") for v in values]
    mean = reduce(lambda a, b: a + b, cols) / float(len(cols))
    squares = reduce(lambda a, b: a + b, [(c - mean) * (c - mean) for c in cols])
    return F.sqrt(F.try_divide(squares, F.lit(float(len(cols) - 1))))


def list_count(value: Column | str, sep: str = ",") -> Column:
    """Number of entries of a delimited list; NULL counts 0, an empty string counts 1."""
    v = as_col(value)
    return F.when(v.isNull(), 0).otherwise(F.size(split_list(v, sep)))


def split_list(value: Column | str, sep: str = ",") -> Column:
    """Entries of a list delimited by ``sep``, taken literally."""
    return F.split(as_col(value), re.sub(r"(\W)", r"\\\1", sep))


def title_text(value: Column | str) -> Column:
    """Underscores to spaces, punctuation removed, spaces collapsed, each word capitalised."""
    spaced = F.translate(as_col(value), "_", " ")
    # (?U): letters and spaces of every script, not only ASCII
    plain = F.regexp_replace(spaced, r"(?U)[^\w\s]", "")
    return F.trim(F.initcap(F.regexp_replace(plain, r"(?U)\s+", " ")))


def hash_percent(key: Column | str) -> Column:
    """Stable bucket 0..99 of a key: the first 8 hex digits of its md5, modulo 100."""
    return F.pmod(F.conv(F.substring(F.md5(as_col(key).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(100))


def hash_uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends only on the key and the salt, not on partitioning."""
    digits = F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(16**12)


def hash_normal(key: Column, salt: str, mean: float = 0.0, sd: float = 1.0) -> Column:
    """A normal variate derived from the key by the Box-Muller transform."""
    u, v = hash_uniform(key, salt + "/u"), hash_uniform(key, salt + "/v")
    return mean + sd * F.sqrt(-2.0 * F.ln(1.0 - u)) * F.cos(2.0 * F.pi() * v)


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    v = as_col(value)
    return F.when(v < low, low).when(v > high, high).otherwise(v)


def bin_floor(value: Column | str, width: float, origin: float = 0.0) -> Column:
    """Lower edge of the equal-width bin that holds the value."""
    return F.floor((as_col(value) - origin) / width) * width + origin
