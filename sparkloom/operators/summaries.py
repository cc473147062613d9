"""Aggregations: column profiles, histograms, modes and null-skipping summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.operators.joins import lookup_join
from sparkloom.workspace import written


def _is_number(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, T.NumericType)


def _profiled(frame: DataFrame, columns: list[str] | None) -> list[str]:
    names = columns or frame.columns
    kinds = (T.NumericType, T.StringType)
    return [name for name in names if isinstance(frame.schema[name].dataType, kinds)]


def _long_form(wide: DataFrame, names: list[str], statistics: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(name).alias("column"), *[F.col(f"s{i}")[s].alias(s) for s in statistics])
                     for i, name in enumerate(names)])
    return wide.select(F.inline(rows))


def profile_basic(frame: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of every number or text column.

    One row per column. Mean and deviation are null for text; minimum and maximum are given as text,
    since the columns differ in type. Numbers and texts are two aggregates over their own columns, so
    that the number half runs as compiled hash aggregation; each column is still read once.
    """
    names = _profiled(frame, columns)
    no_number = F.lit(None).cast("double")

    def half(names: list[str], number: bool) -> DataFrame:
        wide = frame.agg(*[F.struct(
            F.count(name).alias("count"),
            (F.avg(name) if number else no_number).alias("mean"),
            (F.stddev_samp(name) if number else no_number).alias("stddev"),
            F.min(name).cast("string").alias("min"),
            F.max(name).cast("string").alias("max")).alias(f"s{i}") for i, name in enumerate(names)])
        return _long_form(wide, names, ["count", "mean", "stddev", "min", "max"])

    numbers = [name for name in names if _is_number(frame, name)]
    texts = [name for name in names if name not in numbers]
    halves = [half(part, part is numbers) for part in (numbers, texts) if part]
    if not halves:
        return frame.sparkSession.createDataFrame(
            [], "column string, count bigint, mean double, stddev double, min string, max string")
    return reduce(DataFrame.unionByName, halves)


def _label(fraction: float) -> str:
    return f"p{fraction * 100:g}".replace(".", "_")


def _classes(frame: DataFrame, names: list[str]) -> dict[str, list[str]]:
    """Number columns by a type that holds all their values exactly.

    Doubles hold floats, whole numbers up to 2^53 and decimals of up to 15 digits; other columns have their own type.
    Runs one pass over the long columns.
    """
    long = [n for n in names if isinstance(frame.schema[n].dataType, T.LongType)]
    bounds = frame.agg(*[F.struct(F.min(f"`{n}`"), F.max(f"`{n}`")) for n in long]).first() if long else ()
    beyond = {n for n, ends in zip(long, bounds) if any(v is not None and abs(v) > 1 << 53 for v in ends)}
    out: dict[str, list[str]] = {}
    for name in names:
        kind = frame.schema[name].dataType
        own = name in beyond or isinstance(kind, T.DecimalType) and kind.precision > 15
        out.setdefault(kind.simpleString() if own else "double", []).append(name)
    return out


def profile_quantiles(frame: DataFrame, columns: list[str] | None = None,
                      fractions: tuple[float, ...] = (0.25, 0.5, 0.75), as_text: bool = False) -> DataFrame:
    """Minimum, chosen quantiles and maximum of every number column, found among the values themselves.

    A quantile is the smallest value that at least this fraction of the values does not exceed; nulls do not count.
    Values are counted and sorted without loss; they are returned as doubles, or `as_text` with all their digits, as
    texts of the column's type. Equal values of a column are counted first and written once. The counts are sorted by ranges of
    (column, value); the sum of each range says where a rank falls, and only running sums within ranges are needed to
    find it, so no column meets in one task. Columns are named after the percentage, such as `p25`. Runs three jobs at once.
    """
    names = [n for n in (columns or frame.columns) if _is_number(frame, n)]
    labels, kind = [_label(fraction) for fraction in fractions], "string" if as_text else "double"
    if not names:
        return frame.sparkSession.createDataFrame([], ", ".join(
            ["column string", f"min {kind}", *[f"{label} {kind}" for label in labels], f"max {kind}"]))
    # A value stands in the field of its type's class; the fields of other classes are null.
    classes = _classes(frame, names)
    fields = {k: f"v{i}" for i, k in enumerate(classes)}
    values = list(fields.values())
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), *[
        (F.col(f"`{n}`") if held == k else F.lit(None)).cast(k).alias(v) for k, v in fields.items()])
        for held, members in classes.items() for n in members])
    counts = frame.select(F.inline(pairs)).groupBy("column", *values).agg(F.count("*").alias("n"))
    counts = written(counts, "value-counts").where(" OR ".join(f"{v} IS NOT NULL" for v in values))
    ranges = written(counts.repartitionByRange("column", *values).withColumn("part", F.spark_partition_id()), "value-ranges")
    sums = ranges.groupBy("column", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column")  # a row for each range of the column
    sums = sums.select("column", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                       F.sum("n").over(whole).alias("total"))
    inside = Window.partitionBy("column", "part").orderBy(*values).rowsBetween(Window.unboundedPreceding, 0)
    placed = (ranges.withColumn("upto", F.sum("n").over(inside)).join(sums, ["column", "part"])
              .withColumn("upto", F.col("upto") + F.col("before")))
    reached = [("min", F.lit(True)), *[(label, F.col("upto") >= F.ceil(F.lit(fraction) * F.col("total")))
                                       for fraction, label in zip(fractions, labels)],
               ("max", F.col("upto") >= F.col("total"))]
    found = [F.struct(*[F.min(F.when(test, F.col(v))).alias(v) for v in values]).alias(label) for label, test in reached]
    seen = placed.groupBy("column").agg(*found)
    every = frame.sparkSession.createDataFrame([(n,) for n in names], "column string")

    def shown(label: str) -> Column:
        if not as_text:
            return F.coalesce(*[F.col(label)[v].cast("double") for v in values]).alias(label)
        of = F.lit(None).cast("string")
        for held, members in classes.items():
            for name in members:
                of = F.when(F.col("column") == name, F.col(label)[fields[held]].cast(
                    frame.schema[name].dataType).cast("string")).otherwise(of)
        return of.alias(label)

    return every.join(seen, "column", "left").select("column", *[shown(label) for label, _ in reached])


def profile_sketch(frame: DataFrame, columns: list[str] | None = None,
                   fractions: tuple[float, ...] = (0.25, 0.5, 0.75), accuracy: int = 1000) -> DataFrame:
    """Count, mean, deviation, extremes and quantiles of number and text columns in one pass over the table.

    Quantiles come from a mergeable sketch: each is a value of the column whose rank is off by at most
    count / `accuracy`; the sketch holds a number of values that depends on the accuracy. Everything is null for text
    but count, minimum and maximum, and all values are given as text, since the columns differ in type.
    """
    names, nothing = _profiled(frame, columns), F.lit(None)
    labels = [_label(fraction) for fraction in fractions]
    schema = ["column string", "count bigint", "mean double", "stddev double", "min string",
              *[f"{label} string" for label in labels], "max string"]
    if not names:
        return frame.sparkSession.createDataFrame([], ", ".join(schema))

    def summary(name: str) -> Column:
        number, value = _is_number(frame, name), F.col(f"`{name}`")
        sketch = F.percentile_approx(value, list(fractions), accuracy) if number and fractions else None
        return F.struct(
            F.count(value).alias("count"), (F.avg(value).cast("double") if number else nothing.cast("double")).alias("mean"),
            (F.stddev_samp(value) if number else nothing.cast("double")).alias("stddev"),
            F.min(value).cast("string").alias("min"),
            *[(F.get(sketch, F.lit(k)).cast("string") if number else nothing.cast("string")).alias(label)
              for k, label in enumerate(labels)],
            F.max(value).cast("string").alias("max"))

    wide = frame.agg(*[summary(name).alias(f"s{i}") for i, name in enumerate(names)])
    return _long_form(wide, names, [column.split(" ")[0] for column in schema[1:]])


def profile_summary(frame: DataFrame, columns: list[str] | None = None,
                    fractions: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """`profile_basic` of number and text columns with the quantiles of number columns beside it."""
    quantiles = profile_quantiles(frame, columns, fractions).drop("min", "max")
    return profile_basic(frame, columns).join(quantiles, "column", "left")


def rounded_histogram(frame: DataFrame, column: str, digits: int = 1, bucket: str = "bucket") -> DataFrame:
    """Rows per rounded value; null counts as 0 before rounding."""
    return (frame.fillna(0, [column])
            .groupBy(F.round(column, digits).alias(bucket)).agg(F.count("*").alias("count")))


def modal_values(frame: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value per key, all ties kept.

    Counts are written once, reduced to each key's peak and matched on (key, count), so no key's values
    ever sit in one task. Runs a job at once.
    """
    counts = written(frame.groupBy(key, value).agg(F.count("*").alias("_n")), "value-counts")
    peaks = counts.groupBy(key).agg(F.max("_n").alias("_n"))
    return lookup_join(counts, peaks, [key, "_n"], "left_semi").select(key, value)


def null_safe_summary(frame: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """Sum, mean, count, extremes and first/last value by `order`, each skipping null values.

    `order` should be unique within a group; among equal ones the choice of first and last is open.
    """
    rank = F.when(F.col(value).isNotNull(), F.col(order))
    return frame.groupBy(group).agg(
        F.sum(value).alias("sum"), F.avg(value).alias("avg"), F.count(value).alias("count"),
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.min_by(value, rank).alias("first"), F.max_by(value, rank).alias("last"))
