"""Whole-table profile, exact and by mergeable sketches, histograms, extremes, pivot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import percent_of


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def profile_exact(df: DataFrame, digits: int = 4) -> DataFrame:
    """Per column: type, rows, nulls, null share, min, max and mean, in one pass."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        if _is_number(f.dataType):
            aggs.append(F.avg(c).alias(f"avg{i}"))
    rows = F.col("rows")
    out = []
    for i, f in enumerate(df.schema.fields):
        nulls = rows - F.col(f"n{i}")
        mean = F.round(F.col(f"avg{i}"), digits) if _is_number(f.dataType) else F.lit(None).cast("double")
        out.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                rows.alias("rows"),
                nulls.alias("nulls"),
                percent_of(nulls, rows).alias("null_pct"),
                F.col(f"lo{i}").cast("string").alias("min"),
                F.col(f"hi{i}").cast("string").alias("max"),
                mean.alias("mean"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*out)))


#: Size of a quantile sketch, and the share of rows by which a quantile of it may be off; three times what it is in 99 of 100 cases.
KLL_SIZE, RANK_ERROR = 400, 0.02
#: Size of a sketch of distinct values (a power of two), and the share by which its estimate may be off; six standard errors.
HLL_SIZE, DISTINCT_ERROR = 14, 0.05
QUARTILES = (0.25, 0.5, 0.75)


def column_sketches(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group with a mergeable summary of each column ``i``: values ``n{i}``, a sketch of its distinct values ``h{i}``,
    and for numbers mean ``mean{i}``, squared deviations ``m{i}`` and a sketch of its quantiles ``k{i}``.

    In one pass. Such rows may be stored, as for each day, and merged later in any order.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"n{i}"), F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), HLL_SIZE).alias(f"h{i}")]
        if _is_number(f.dataType):
            x = c.cast("double")
            finite = F.when(~F.isnan(x), x)
            aggs += [F.avg(x).alias(f"mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"m{i}"), F.kll_sketch_agg_double(finite, KLL_SIZE).alias(f"k{i}")]
    return df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*aggs)


def merged_sketches(sketches: DataFrame, fields: Sequence[T.StructField], by: Sequence[str] = ()) -> DataFrame:
    """Summaries of ``column_sketches`` merged into one, or one per group."""
    aggs: list[Column] = [F.sum("rows").alias("rows")]
    for i, f in enumerate(fields):
        n = F.col(f"n{i}")
        aggs += [F.sum(n).alias(f"n{i}"), F.hll_union_agg(f"h{i}").alias(f"h{i}")]
        if _is_number(f.dataType):
            mean = F.try_divide(F.sum(F.col(f"mean{i}") * n), F.sum(n))
            # The squares about the common mean: those about each mean, and each mean's own.
            squares = F.sum(f"m{i}") + F.sum(n * F.col(f"mean{i}") * F.col(f"mean{i}")) - F.sum(n) * mean * mean
            aggs += [mean.alias(f"mean{i}"), squares.alias(f"m{i}"), F.kll_merge_agg_double(f"k{i}").alias(f"k{i}")]
    return sketches.groupBy(*by).agg(*aggs)


def profile_of_sketches(one_row: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Per column: approximate distinct count; for numbers also deviation and quartiles."""
    none = F.lit(None).cast("double")
    out = []
    for i, f in enumerate(fields):
        number = _is_number(f.dataType)
        deviation = F.when(F.col(f"n{i}") > 1, F.sqrt(F.greatest(F.lit(0.0), F.col(f"m{i}")) / (F.col(f"n{i}") - 1))) if number else none
        quartiles = [F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"k{i}", F.lit(q))) if number else none for q in QUARTILES]
        out.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.coalesce(F.hll_sketch_estimate(f"h{i}"), F.lit(0)).alias("approx_distinct"),
                deviation.alias("std"),
                *[q.alias(n) for q, n in zip(quartiles, ("q25", "q50", "q75"))],
            )
        )
    return one_row.select(F.inline(F.array(*out)))


def profile_approximate(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per column: approximate distinct count; for numbers also deviation and quartiles. Summaries are made ``by`` group and merged."""
    fields = df.schema.fields
    return profile_of_sketches(merged_sketches(column_sketches(df, by), fields), fields)


def profile_verified(df: DataFrame, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """The sketches held against the rows: per column its rows, exact distinct count and deviation, and whether the approximate
    distinct count and quartiles are within their bounds.

    A quartile is judged by the rows that are smaller and by those that aren't greater.
    Each column is read by itself and grouped by its values, whose numbers of rows tell all of this: rows are summed up
    before the shuffle, and none is made once for each column. Distinct counts are exact and shuffle each column's
    values: this is for checking, ``profile_approximate`` for use.
    """
    names = ("q25", "q50", "q75")
    approximate = profile_approximate(df, by)
    found = approximate.agg(F.map_from_entries(F.collect_list(F.struct("column_name", F.struct("approx_distinct", "std", *names)))).alias("p")).scalar()
    judged = []
    for f in df.schema.fields:
        number = _is_number(f.dataType)
        values = df.groupBy(F.col(f"`{f.name}`").alias("v")).agg(F.count(F.lit(1)).alias("k")).withColumn("p", found[F.lit(f.name)])
        v, k = F.col("v"), F.col("k")
        sums = {"rows": k, "n": F.when(v.isNotNull(), k)}
        if number:
            for q in names:
                sums |= {f"below_{q}": F.when(v < F.col("p")[q], k), f"upto_{q}": F.when(v <= F.col("p")[q], k)}
        counted = values.agg(F.count("v").alias("exact"), *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(name) for name, c in sums.items()])
        p = F.when(F.col("rows") > 0, found[F.lit(f.name)])
        within = [
            (F.col(f"below_{q}") <= F.col("n") * (share + RANK_ERROR)) & (F.col(f"upto_{q}") >= F.col("n") * (share - RANK_ERROR)) if number else F.lit(None).cast("boolean")
            for q, share in zip(names, QUARTILES)
        ]
        judged.append(counted.select(
            F.lit(f.name).alias("column_name"), "rows", F.col("exact").alias("distinct_values"),
            (F.abs(p["approx_distinct"] - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * DISTINCT_ERROR)).alias("distinct_within"),
            F.round(p["std"], digits).alias("std"), *[w.alias(f"{q}_within") for w, q in zip(within, names)],
        ))
    return reduce(DataFrame.unionAll, judged)


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, in value order, null last."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_last(column))


def top_histogram(df: DataFrame, value: Column, name: str, top: int) -> DataFrame:
    """The ``top`` most frequent values; ties by value."""
    counted = df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc_nulls_last(name)).limit(top)


def extremes(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Maximum per column; ``columns`` maps result names to columns."""
    return df.agg(*[F.max(c).alias(n) for n, c in columns.items()])


def matrix(df: DataFrame, rows: str, columns: str, values: Sequence[int], cell: Column, prefix: str) -> DataFrame:
    """Pivot with given column values, so Spark needs no pass to find them."""
    wide = df.groupBy(rows).pivot(columns, list(values)).agg(cell)
    return wide.select(rows, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])
