"""Data-quality checks.

A rate check is a pair of conditions (hit, base). ``measure`` evaluates any number
of them in one aggregate over the data and returns one row per check:
``check, column, numerator, denominator, rate``. ``rate`` is the check's own
``empty_rate`` when the denominator is 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from verisift.functions.exprs import ref_day
from verisift.functions.skew import mark_first
from verisift.session import scratch_path

#: Rows of a key, of both sides, that are compared in one task.
KEY_ROWS = 100_000
METRIC_COLUMNS = ("check", "column", "numerator", "denominator", "rate")


@dataclass(frozen=True)
class Rate:
    check: str
    column: str
    hit: Column
    base: Column
    empty_rate: float


# -- rate checks over single rows ------------------------------------------------


def required(*columns: str) -> list[Rate]:
    """Share of rows where the column is filled."""
    return [
        Rate("required", c, F.col(c).isNotNull(), F.lit(True), 0.0) for c in columns
    ]


def null_share(*columns: str) -> list[Rate]:
    """Share of rows where the column is empty."""
    return [Rate("null_rate", c, F.col(c).isNull(), F.lit(True), 1.0) for c in columns]


def in_range(column: str, low: object, high: object) -> Rate:
    """Share of filled values inside the closed range."""
    value = F.col(column)
    return Rate("in_range", column, value.between(low, high), value.isNotNull(), 1.0)


def valid_codes(column: str, allowed: Sequence[object]) -> Rate:
    """Share of filled values that belong to the code set."""
    value = F.col(column)
    return Rate("valid_codes", column, value.isin(list(allowed)), value.isNotNull(), 1.0)


def date_order(start: str, end: str) -> Rate:
    """Share of rows with both dates where the start lies strictly before the end."""
    both = F.col(start).isNotNull() & F.col(end).isNotNull()
    return Rate("date_order", f"{start}<{end}", F.col(start) < F.col(end), both, 1.0)


def positive(*columns: str) -> list[Rate]:
    """Share of filled values above zero."""
    return [
        Rate("positive", c, F.col(c) > 0, F.col(c).isNotNull(), 1.0) for c in columns
    ]


def within_sla(event: str, received: str, days: int) -> Rate:
    """Share of all rows received at most ``days`` after the event; a missing date is a miss."""
    lag = F.datediff(F.col(received), F.col(event))
    return Rate("within_sla", received, lag <= days, F.lit(True), 1.0)


def measure(df: DataFrame, rates: Sequence[Rate]) -> DataFrame:
    """All the rates in one pass over the data."""
    counts = []
    for i, r in enumerate(rates):
        counts.append(F.count_if(r.hit & r.base).alias(f"_h{i}"))
        counts.append(F.count_if(r.base).alias(f"_b{i}"))
    rows = [
        _metric(r.check, r.column, F.col(f"_h{i}"), F.col(f"_b{i}"), r.empty_rate)
        for i, r in enumerate(rates)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def _metric(check: str, column: str, hits: Column, base: Column, empty_rate: float) -> Column:
    rate = F.coalesce(
        F.try_divide(hits.cast("double"), base.cast("double")), F.lit(empty_rate)
    )
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        hits.cast("long").alias("numerator"),
        base.cast("long").alias("denominator"),
        rate.alias("rate"),
    )


def _one_metric(
    counts: DataFrame, check: str, column: str, hits: Column, base: Column, empty_rate: float
) -> DataFrame:
    zero = F.lit(0)
    return counts.agg(
        F.coalesce(F.sum(hits), zero).alias("_h"), F.coalesce(F.sum(base), zero).alias("_b")
    ).select(F.inline(F.array(_metric(check, column, F.col("_h"), F.col("_b"), empty_rate))))


# -- completeness of sets --------------------------------------------------------


def _expected(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(values)), f"position INT, {name} STRING")


def missing_periods(df: DataFrame, date_column: str, expected: Sequence[str]) -> DataFrame:
    """The expected ``yyyy-MM`` periods without any row, numbered as in the list."""
    seen = df.select(F.date_format(F.col(date_column), "yyyy-MM").alias("period")).distinct()
    return _expected(df.sparkSession, "period", expected).join(seen, "period", "left_anti").select(
        "position", "period"
    )


def missing_sources(df: DataFrame, source_column: str, expected: Sequence[str]) -> DataFrame:
    """The expected sources without any row, numbered as in the list."""
    seen = df.select(F.col(source_column).cast("string").alias("source")).distinct()
    return _expected(df.sparkSession, "source", expected).join(seen, "source", "left_anti").select(
        "position", "source"
    )


# -- uniqueness ------------------------------------------------------------------


def duplicate_rate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key, over all rows; NULL counts as a key value."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _one_metric(
        groups, "duplicate_rate", ",".join(keys), F.col("_n") - 1, F.col("_n"), 0.0
    )


def flag_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_is_duplicate``: false on the first row of each key by ``order``, true on the rest."""
    return mark_first(df, keys, order).select(
        *df.columns, (~F.col("_first")).alias("_is_duplicate")
    )


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``.

    A minimum is combined before the shuffle, so a key with many rows is cheap.
    """
    rank = F.struct(
        *[F.col(c) for c in order], F.xxhash64(*[F.col(c) for c in df.columns]).alias("_print")
    )
    kept = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.min_by(F.struct(*df.columns), rank).alias("_row")
    )
    return kept.select("_row.*")


# -- consistency -----------------------------------------------------------------


def referential_integrity(
    df: DataFrame, foreign_key: str, reference: DataFrame, primary_key: str
) -> DataFrame:
    """Share of filled foreign keys found in the reference.

    Foreign keys are counted first and looked up once each.
    """
    used = (
        df.where(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = (
        reference.where(F.col(primary_key).isNotNull())
        .select(F.col(primary_key).alias("_key"))
        .distinct()
        .withColumn("_found", F.lit(1))
    )
    found = F.when(F.col("_found").isNotNull(), F.col("_n")).otherwise(F.lit(0))
    return _one_metric(
        used.join(known, "_key", "left"),
        "referential_integrity",
        foreign_key,
        found,
        F.col("_n"),
        1.0,
    )


def cross_source_alignment(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Per column, equal values over all pairs of rows that share the key.

    Pairs are counted, not built: the counts of a value on both sides are multiplied. The rows
    of a key are moved once, to one task; keys of very many rows, which are stored, are counted
    by (key) and by (key, value) over all tasks. NULL equals nothing.
    """
    columns = list(columns)
    a, b = (df.where(F.col(key).isNotNull()).select(key, *columns) for df in (left, right))
    totals = None
    if [f.dataType for f in a.schema] == [f.dataType for f in b.schema]:
        counts, path = Observation(), scratch_path(left.sparkSession, "large-keys")
        (
            a.select(key).unionByName(b.select(key)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > KEY_ROWS).select(key).observe(counts, F.count(F.lit(1)).alias("keys"))
            .write.parquet(path)
        )
        if not counts.get["keys"]:
            totals = _equal_by_key(a, b, key, columns)
        else:
            large = left.sparkSession.read.parquet(path)
            totals = _equal_by_key(*[df.join(large, key, "left_anti") for df in (a, b)], key, columns)
            a, b = (df.join(large, key, "left_semi") for df in (a, b))
            totals = totals.unionByName(_equal_by_value(a, b, key, columns))
    else:
        totals = _equal_by_value(a, b, key, columns)
    names = ["_b", *[f"_h{i}" for i in range(len(columns))]]
    rows = [
        _metric("cross_source", c, F.col(f"_h{i}"), F.col("_b"), 0.0)
        for i, c in enumerate(columns)
    ]
    return totals.agg(*[F.sum(n).alias(n) for n in names]).select(F.inline(F.array(*rows)))


def _equal_by_key(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: pairs with the same key (``_b``) and, per column, with the same value (``_h<i>``)."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = a.withColumns({"_na": one, "_nb": none}).unionByName(b.withColumns({"_na": none, "_nb": one})).repartition(key)
    # the row itself and each of its values
    cells = [
        F.struct(F.lit(i).alias("_set"), *[(F.col(c) if i == j else F.lit(None)).alias(c) for j, c in enumerate(columns)])
        for i in range(-1, len(columns))
    ]
    told = both.select(F.col(key), "_na", "_nb", F.inline(F.array(*cells)))
    met = told.groupBy(key, "_set", *columns).agg(F.sum("_na").alias("_na"), F.sum("_nb").alias("_nb"))
    pairs, zero = F.col("_na") * F.col("_nb"), F.lit(0)
    totals = [F.coalesce(F.sum(F.when(F.col("_set") == -1, pairs)), zero).alias("_b")]
    for i, c in enumerate(columns):
        equal = (F.col("_set") == i) & F.col(c).isNotNull()
        totals.append(F.coalesce(F.sum(F.when(equal, pairs)), zero).alias(f"_h{i}"))
    return met.agg(*totals)


def _equal_by_value(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``_equal_by_key`` with each side counted by (key) and by (key, value) in one grouping-sets pass."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        sets = [[key]] + [[key, c] for c in columns]
        return df.groupingSets(sets, key, *columns).agg(
            F.grouping_id(key, *columns).alias("_set"), F.count(F.lit(1)).alias(name)
        )

    # In a grouping set the columns left out are NULL on both sides, hence null-safe.
    a, b = counted(left, "_na").alias("a"), counted(right, "_nb").alias("b")
    condition = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a._set") == F.col("b._set"))
    for c in columns:
        condition = condition & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    width = len(columns)
    sets = {c: (1 << width) - 1 - (1 << (width - 1 - i)) for i, c in enumerate(columns)}
    pairs = F.col("_na") * F.col("_nb")
    joined = a.join(b, condition).select(
        F.col("a._set").alias("_set"), "_na", "_nb", *[F.col(f"a.{c}").alias(c) for c in columns]
    )
    zero = F.lit(0)
    totals = [F.coalesce(F.sum(F.when(F.col("_set") == (1 << width) - 1, pairs)), zero).alias("_b")]
    for i, c in enumerate(columns):
        equal = (F.col("_set") == sets[c]) & F.col(c).isNotNull()
        totals.append(F.coalesce(F.sum(F.when(equal, pairs)), zero).alias(f"_h{i}"))
    return joined.agg(*totals)


# -- timeliness and accuracy flags -----------------------------------------------


def with_staleness(
    df: DataFrame, date_column: str, *, max_days: int = 90, as_of: object = None
) -> DataFrame:
    """Add ``_staleness_score``: age over ``max_days``, held to 0..1; no date counts as 1."""
    age = F.datediff(ref_day(as_of), F.col(date_column)) / F.lit(float(max_days))
    held = F.greatest(F.lit(0.0), F.least(F.lit(1.0), age))
    return df.withColumn(
        "_staleness_score", F.when(F.col(date_column).isNull(), F.lit(1.0)).otherwise(held)
    )


def flag_outliers(
    df: DataFrame, column: str, *, z_threshold: float = 3.0, within: Sequence[str] = ()
) -> DataFrame:
    """Add ``_is_outlier_<column>``: farther than ``z_threshold`` deviations from the mean.

    ``within`` measures mean and deviation per group. A missing or zero deviation
    counts as 1, a missing mean as 0.
    """
    value = F.col(column).cast("double")
    moments = F.struct(
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.nullif(F.stddev_samp(value), F.lit(0.0)), F.lit(1.0)).alias("dev"),
    )
    flag = f"_is_outlier_{column}"

    def far(m: Column) -> Column:
        return F.abs((value - m["mean"]) / m["dev"]) > z_threshold

    if not within:
        return df.withColumn(flag, far(df.agg(moments).scalar()))
    groups = df.groupBy(*[F.col(g).alias(f"_in_{g}") for g in within]).agg(moments.alias("_m"))
    condition = F.lit(True)
    for g in within:
        condition = condition & F.col(g).eqNullSafe(F.col(f"_in_{g}"))
    return df.join(groups, condition, "left").select(*df.columns, far(F.col("_m")).alias(flag))
