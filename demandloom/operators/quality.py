"""Data-quality reports over raw and located sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.casts import lenient_double

# Fixed value: the number at which the feed truncates sales.
CAP = 9999.0


def junk_values(sales: DataFrame) -> DataFrame:
    """Texts in the sales column that are not numbers, with their row count."""
    text = F.col("sales")
    junk = sales.filter(text.isNotNull() & lenient_double(text).isNull())
    return junk.groupBy(text.alias("sales")).agg(F.count(F.lit(1)).alias("rows"))


def sales_by_weekday(located: DataFrame) -> DataFrame:
    """Sum of numeric sales per weekday, Monday = 0."""
    return located.groupBy(F.weekday("date").cast("long").alias("weekday")).agg(
        F.sum(lenient_double(F.col("sales"))).alias("sales")
    )


def value_frequency(located: DataFrame) -> DataFrame:
    """Rows per sales text and their percentage, most frequent first.

    Missing sales are counted as the text ``nan``. The total is a scalar subquery over
    the counted values, whose shuffle is reused.
    """
    text = F.coalesce(F.col("sales"), F.lit("nan"))
    counts = located.groupBy(text.alias("sales")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn(
        "percentage", 100.0 * F.round(F.col("count") / total, 4)
    ).orderBy(F.desc("count"), "sales")


def cap_share(
    located: DataFrame,
    keys: Sequence[str],
    cap: float = CAP,
    of_values: bool = False,
    zero_when_absent: bool = True,
) -> DataFrame:
    """Rows, rows at the cap, and their share, per key, in one aggregation.

    ``of_values`` counts only numeric sales in the total. Without ``zero_when_absent``
    a key that never meets the cap has null instead of 0.
    """
    value = lenient_double(F.col("sales"))
    total = F.count(value) if of_values else F.count(F.lit(1))
    capped = F.count_if(value == F.lit(cap))
    if not zero_when_absent:
        capped = F.nullif(capped, F.lit(0))
    columns = [F.weekday("date").cast("long").alias(k) if k == "weekday" else F.col(k) for k in keys]
    return (
        located.groupBy(*columns)
        .agg(total.alias("total"), capped.alias("capped"))
        .withColumn("share", F.when(F.col("total") > 0, F.col("capped") / F.col("total")))
    )


def capped_keys(
    located: DataFrame, key_sets: Sequence[Sequence[str]], cap: float = CAP
) -> DataFrame:
    """How many keys of each kind meet the cap at least once, in one pass."""
    capped = located.filter(lenient_double(F.col("sales")) == F.lit(cap))
    wide = capped.agg(
        *(F.count_distinct(*(F.col(k) for k in keys)).alias(f"_{i}") for i, keys in enumerate(key_sets))
    )
    rows = (
        F.struct(F.lit("+".join(keys)).alias("key"), F.col(f"_{i}").alias("capped_keys"))
        for i, keys in enumerate(key_sets)
    )
    return wide.select(F.inline(F.array(*rows)))


def unmatched_share(with_city: DataFrame) -> DataFrame:
    """Rows without a city and their percentage, out of ``first_city``."""
    return with_city.agg(
        F.count_if(F.col("city").isNull()).alias("unmatched"),
        F.round(100.0 * F.count_if(F.col("city").isNull()) / F.count(F.lit(1)), 2).alias("pct"),
    )


def series_coverage(sales: DataFrame, geo: DataFrame, located: DataFrame) -> DataFrame:
    """Possible (city, product) pairs, pairs with sales, and their percentage.

    The possible pairs are the product of two distinct counts; they are not listed.
    """
    products = sales.select("product_id").distinct().agg(F.count("product_id")).scalar()
    cities = geo.select("city").distinct().agg(F.count("city")).scalar()
    observed = located.select("city", "product_id").distinct()
    return observed.agg(F.count(F.lit(1)).alias("observed")).select(
        (products * cities).alias("possible"),
        "observed",
        F.round(100.0 * F.col("observed") / (products * cities), 2).alias("pct"),
    )


def profile_columns(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, missing, distinct, minimum and maximum of every column, as text.

    Exact distinct counts cost one copy of each row per column before the map-side
    combine; ``approximate`` replaces them with sketches of fixed size, and
    ``profile_sketches`` gives sketches that can be kept and merged.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    columns = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count(c).alias(f"known_{i}") for i, c in enumerate(columns)),
        *(distinct(F.col(c)).alias(f"distinct_{i}") for i, c in enumerate(columns)),
        *(F.min(c).cast("string").alias(f"min_{i}") for i, c in enumerate(columns)),
        *(F.max(c).cast("string").alias(f"max_{i}") for i, c in enumerate(columns)),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("column"),
                F.col("rows"),
                (F.col("rows") - F.col(f"known_{i}")).alias("missing"),
                F.when(
                    F.col("rows") > 0,
                    F.round(100.0 * (F.col("rows") - F.col(f"known_{i}")) / F.col("rows"), 2),
                ).alias("missing_pct"),
                F.col(f"distinct_{i}").alias("distinct"),
                F.col(f"min_{i}").alias("min"),
                F.col(f"max_{i}").alias("max"),
            )
            for i, name in enumerate(columns)
        )
    )
    return wide.select(F.inline(rows))


# A quantile sketch of this size errs by less than this share of the ranks, a
# distinct count by less than this share of itself (about three standard errors each).
SKETCH_SIZE, RANK_ERROR = 400, 0.02
DISTINCT_BITS, DISTINCT_ERROR = 12, 0.05
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def profile_sketches(df: DataFrame) -> DataFrame:
    """(column, rows, distinct, quantiles): sketches of every column in one pass.

    ``distinct`` is a sketch of the different values, ``quantiles`` one of a numeric column's
    distribution (null for others). They are of fixed size whatever the rows, and those of
    parts of a table (days, files) can be merged: keep them beside the data and profile any
    union without reading it again.
    """
    numeric = _numeric(df)
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        aggregates.append(F.count(c).alias(f"known_{i}"))
        aggregates.append(F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_BITS).alias(f"distinct_{i}"))
        if c in numeric:
            aggregates.append(F.kll_sketch_agg_double(F.col(c).cast("double"), SKETCH_SIZE).alias(f"quantiles_{i}"))
    empty = F.lit(None).cast("binary")
    rows = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"), F.col("rows"), F.col(f"known_{i}").alias("known"),
                F.col(f"distinct_{i}").alias("distinct"),
                (F.col(f"quantiles_{i}") if c in numeric else empty).alias("quantiles"),
            )
            for i, c in enumerate(df.columns)
        )
    )
    return df.agg(*aggregates).select(F.inline(rows))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column from sketches of several parts."""
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def sketched_profile(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(column, rows, missing, distinct, quantile, value): estimates from sketches, one row per
    quantile of a numeric column and one without for others.

    Ranks err by less than ``RANK_ERROR``, distinct counts by less than ``DISTINCT_ERROR`` of
    themselves; a column without values has 0 distinct and null quantiles.
    """
    asked = F.array(*(F.lit(float(q)) for q in quantiles))
    none = F.array(F.struct(F.lit(None).cast("double").alias("quantile"), F.lit(None).cast("double").alias("value")))
    values = F.zip_with(
        asked, F.kll_sketch_get_quantile_double("quantiles", asked),
        lambda q, v: F.struct(q.alias("quantile"), v.alias("value")),
    )
    usable = F.kll_sketch_get_n_double("quantiles") > 0
    return sketches.select(
        "column", "rows", (F.col("rows") - F.col("known")).alias("missing"),
        F.hll_sketch_estimate("distinct").alias("distinct"),
        F.inline(F.when(usable, values).otherwise(none)),
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(left, right, value) for every pair of numeric columns, in one pass and fixed memory.

    A pair's rows are those with both values; a column that does not vary has null.
    """
    columns = list(columns or _numeric(df))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    if not pairs:
        raise ValueError("correlations need two numeric columns or more")

    def value(a: str, b: str) -> Column:
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        return F.when(spread > 0, F.covar_pop(a, b) / spread)

    wide = df.agg(*(value(a, b).alias(f"corr_{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.array(
        *(
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"corr_{i}").alias("value"))
            for i, (a, b) in enumerate(pairs)
        )
    )
    return wide.select(F.inline(rows))


def numeric_profile(df: DataFrame) -> DataFrame:
    """Mean, standard deviation, zeros and negatives of every numeric column."""
    columns = _numeric(df)
    wide = df.agg(
        *(F.avg(c).alias(f"mean_{i}") for i, c in enumerate(columns)),
        *(F.stddev(c).alias(f"std_{i}") for i, c in enumerate(columns)),
        *(F.count_if(F.col(c) == 0).alias(f"zeros_{i}") for i, c in enumerate(columns)),
        *(F.count_if(F.col(c) < 0).alias(f"neg_{i}") for i, c in enumerate(columns)),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"mean_{i}").alias("mean"),
                F.col(f"std_{i}").alias("std"),
                F.col(f"zeros_{i}").alias("zeros"),
                F.col(f"neg_{i}").alias("negatives"),
            )
            for i, name in enumerate(columns)
        )
    )
    return wide.select(F.inline(rows))


def duplicate_rate(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows, and their percentage.

    Copies are counted map-side, so a row repeated a billion times moves once per task.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
        F.round(100.0 * F.sum(F.col("_copies") - 1) / F.sum("_copies"), 2).alias("pct"),
    )
