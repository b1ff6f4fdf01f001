"""Row filters, value cleaning, imputation, deduplication and stable sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions import presets
from tallyforge.functions.expr import classify, clip, hash_percent, hash_uniform, title_text
from tallyforge.operators.joins import with_total_stats
from tallyforge.operators.ranking import column_quantiles, quantiles


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    return df.dropna(how=how, subset=list(columns) if columns else None)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are NULL in every row; one aggregate over all columns."""
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if filled[c] == 0])


def keep_in_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows whose every listed value is inside its closed range; NULL is outside."""
    for column, (low, high) in ranges.items():
        df = df.filter(F.col(column).between(low, high))
    return df


def protect_pii(df: DataFrame, drop: Sequence[str] = (), hashed: Sequence[str] = (), masked: Sequence[str] = ()) -> DataFrame:
    """Remove personal columns, replace others by their SHA-256, or mask letters and digits."""
    out = {c: F.sha2(F.col(c).cast("string"), 256) for c in hashed}
    out |= {c: F.mask(F.col(c).cast("string")) for c in masked}
    return (df.withColumns(out) if out else df).drop(*drop)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to the given types; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row: per column the number of values that the cast would lose."""
    lost = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in types.items()]
    return df.agg(*lost)


def parse_date(df: DataFrame, column: str, formats: Sequence[str], output: str | None = None) -> DataFrame:
    """Text to date by the first format that fits; NULL if none does."""
    tried = [F.try_to_timestamp(F.col(column), F.lit(f)).cast("date") for f in formats]
    return df.withColumn(output or column, F.coalesce(*tried))


def fill_constants(df: DataFrame, values: Mapping[str, float] | None = None) -> DataFrame:
    values = presets.FILL_DEFAULTS if values is None else values
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def _fill(df: DataFrame, columns: Sequence[str], filled: DataFrame) -> DataFrame:
    """``filled`` is ``df`` with a column ``__fill_c`` for each column c."""

    def fitted(c: str) -> Column:
        """The statistic in the column's own type; rounded, not cut, where that is a whole number."""
        kind, value = df.schema[c].dataType, F.col(f"__fill_{c}")
        return (F.round(value) if isinstance(kind, T.IntegralType) else value).cast(kind)

    replaced = {c: F.coalesce(F.col(c), fitted(c)) for c in columns}
    return filled.withColumns(replaced).drop(*[f"__fill_{c}" for c in columns])


def fill_median(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or presets.CLEANED_NUMERIC)
    medians = {f"__fill_{c}": quantiles(df, [], c, [0.5]).select(F.col("quantiles")[0]).scalar() for c in columns}
    return _fill(df, columns, df.withColumns(medians))


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _fill(df, columns, with_total_stats(df, {f"__fill_{c}": F.avg(c) for c in columns}))


def most_common(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent non-NULL value; of equally frequent ones the smallest."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), F.asc(column)).limit(1).select(column)


def fill_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULL by the column's most frequent value.

    Counts are kept in a shuffle per column, not in one map per task, so a column with very many
    distinct values is fine.
    """
    for c in columns:
        df = df.withColumn(c, F.coalesce(F.col(c), most_common(df, c).scalar()))
    return df


def handle_missing(df: DataFrame, strategy: str = "default") -> DataFrame:
    if strategy == "default":
        return fill_constants(df)
    if strategy == "median":
        return fill_median(df)
    return df


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> dict[str, tuple[float, float]]:
    """Per column (q1 - factor*iqr, q3 + factor*iqr) of exact quartiles; all columns in one pass, those without values are left out."""
    row = column_quantiles(df, columns, [0.25, 0.75]).first()
    bounds = {}
    for c in columns:
        if row[c] is not None:
            q1, q3 = row[c]
            bounds[c] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return bounds


def remove_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    factor: float = 1.5,
    sequential: bool = True,
    keep_nulls: bool = False,
) -> DataFrame:
    """Keep rows inside the IQR fences of every column.

    ``sequential`` computes the fences of each column on the rows that survived the columns before
    it; otherwise all fences come from the input.
    """
    columns = list(columns or presets.CLEANED_NUMERIC)

    def fence(frame: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
        for c, (low, high) in bounds.items():
            inside = F.col(c).between(low, high)
            frame = frame.filter(inside | F.col(c).isNull() if keep_nulls else inside)
        return frame

    if not sequential:
        return fence(df, iqr_bounds(df, columns, factor))
    for c in columns:
        df = fence(df, iqr_bounds(df, [c], factor))
    return df


def standardise(
    df: DataFrame, column: str, synonyms: Mapping[str, Sequence[str]], output: str | None = None, ignore_case: bool = False
) -> DataFrame:
    """Replace known spellings by their canonical value; others stay as they are."""
    seen = F.lower(column) if ignore_case else F.col(column)
    rules = [
        (seen.isin([s.lower() if ignore_case else s for s in words]), canonical) for canonical, words in synonyms.items()
    ]
    return df.withColumn(output or column, classify(rules, F.col(column)))


def standardise_student(df: DataFrame) -> DataFrame:
    for column, synonyms in (
        ("field_of_study", presets.FIELD_SYNONYMS),
        ("frequency_of_use", presets.FREQUENCY_SYNONYMS),
    ):
        if column in df.columns:
            df = standardise(df, column, synonyms, f"{column}_clean")
    return df


def prefix_category(column: str | Column, prefixes: Mapping[str, str], default: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return classify([(c.startswith(p), label) for p, label in prefixes.items()], default)


def normalise_courses(df: DataFrame, name: str = "course_name", code: str = "course_code") -> DataFrame:
    return df.withColumns(
        {
            f"{name}_normalized": title_text(name),
            "course_category": prefix_category(code, presets.COURSE_PREFIXES, presets.COURSE_PREFIX_DEFAULT),
        }
    )


def drop_duplicates(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[Column] | None = None) -> DataFrame:
    """Whole-row duplicates, or one row per key.

    With ``order`` the first row in that order survives; Spark keeps one row per key and task before the
    shuffle (``WindowGroupLimit``), so a key with very many copies is no larger than the tasks are many. Without
    it, any of a key's rows survives. NULL sorts first.
    """
    if keys is None:
        return df.dropDuplicates()
    if order is None:
        return df.dropDuplicates(list(keys))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__first", first).filter("__first = 1").drop("__first")


def reconcile(
    df: DataFrame,
    base: str,
    other: str,
    key: str,
    limit: float = 1.5,
    spread: float = 0.3,
    low: float = 0.0,
    high: float = 4.0,
    salt: str = "reconcile",
) -> DataFrame:
    """Where two measures differ by more than ``limit``, redraw ``other`` around ``base``.

    The noise comes from the row key, so a rerun and any partitioning give the same result.
    """
    noise = (hash_uniform(F.col(key), salt) * 2.0 - 1.0) * spread
    redrawn = F.round(clip(F.col(base) + noise, low, high), 2)
    return df.withColumn(other, F.when(F.abs(F.col(base) - F.col(other)) > limit, redrawn).otherwise(F.col(other)))


def hash_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Keep about ``percent`` per cent of the keys; a key is kept in every table or in none."""
    return df.filter(hash_percent(key) < percent)


def fraction_sample(df: DataFrame, fraction: float, seed: int = 42, keys: Sequence[str] = ()) -> DataFrame:
    """A share of the rows: each by chance, or with ``keys`` exactly the nearest whole number of rows, the same ones on every run."""
    if not keys:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return bottom_sample(df, keys, fraction=fraction, salt=str(seed))


_DIGITS = 15  # of a hash in base 16: 60 bits


def key_hash(keys: Sequence[str], salt: str) -> Column:
    """60 bits of the MD5 of the keys' texts and the salt."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts, F.lit(salt))), 1, _DIGITS), 16, 10).cast("long")


def bottom_sample(df: DataFrame, keys: Sequence[str], size: int | None = None, fraction: float | None = None, salt: str = "sample", at_once: int = 10_000) -> DataFrame:
    """The ``size`` rows (or the share of all) whose keys hash lowest; of rows that share all keys, the first by all their columns.

    The size is exact and the rows depend on rows and salt only. The lowest rows of two samples of a size are those of both inputs
    together, so samples merge. The cut is found by counting rows per range of hashes, each time inside the one range that holds
    it, until at most ``at_once`` hashes are left to look at; the rows themselves are never sorted or moved, but for those that share
    the keys of the cut.
    """
    rows = df.withColumn("__hash", key_hash(keys, salt))
    low, width, want = 0, 4 * _DIGITS, size
    taken = 0
    while True:
        step = max(width - 12, 0)
        inside = rows.filter((F.col("__hash") >= low) & (F.col("__hash") < low + (1 << width)))
        counts = {r["part"]: r["n"] for r in inside.groupBy(F.shiftright("__hash", step).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
        if want is None:
            # the nearest whole number, halves up
            want = int(sum(counts.values()) * fraction + 0.5)
        if taken + sum(counts.values()) <= want:
            return df
        for part in sorted(counts):
            if taken + counts[part] > want:
                break
            taken += counts[part]
        low, width = part << step, step
        if counts[part] <= at_once or width == 0:
            break
    last = rows.filter((F.col("__hash") >= low) & (F.col("__hash") < low + (1 << width)))
    # copies of a key are one line, so many of them are no more to look at
    edge = last.groupBy("__hash", *keys).agg(F.count(F.lit(1)).alias("__n")).orderBy("__hash", *keys)
    for cut in edge.toLocalIterator():
        if taken + cut["__n"] > want:
            break
        taken += cut["__n"]
    below, same = F.lit(False), F.col("__hash") == cut["__hash"]
    for i in reversed(range(len(keys))):
        equal = F.col(keys[i]).eqNullSafe(F.lit(cut[keys[i]]))
        below = _before(F.col(keys[i]), cut[keys[i]], rows.schema[keys[i]].dataType) | (equal & below)
        same = same & equal
    lowest = rows.filter((F.col("__hash") < cut["__hash"]) | ((F.col("__hash") == cut["__hash"]) & below)).drop("__hash")
    if taken == want:
        return lowest
    return lowest.union(rows.filter(same).drop("__hash").orderBy(*df.columns).limit(want - taken))


def _before(key: Column, value: object, kind: T.DataType) -> Column:
    """Whether a key comes before a value in Spark's order, where NULL is first."""
    if value is None:
        return F.lit(False)
    return key.isNull() | F.coalesce(key < F.lit(value).cast(kind), F.lit(False))


def train_test_split(df: DataFrame, key: str, train_tenths: int = 8, output: str = "dataset_split") -> DataFrame:
    is_train = F.pmod(hash_percent(key), F.lit(10)) < train_tenths
    return df.withColumn(output, F.when(is_train, "train").otherwise("test"))


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
