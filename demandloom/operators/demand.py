"""Raw transactions to one demand value per group and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.casts import known_or_zero, lenient_double
from demandloom.operators.ranges import (
    RangeLookup,
    first_match_ranges,
    match_ranges,
    measure_ranges,
)


def keep_cities(geo: DataFrame, cities) -> DataFrame:
    """Geo rows of the listed cities; no list keeps them all."""
    return geo.filter(F.col("city").isin(list(cities))) if cities else geo


def _lookup(geo: DataFrame | RangeLookup) -> RangeLookup:
    return geo if isinstance(geo, RangeLookup) else measure_ranges(geo)


def zip_to_city(
    sales: DataFrame, geo: DataFrame | RangeLookup, unique_by: list[str] | None = None
) -> DataFrame:
    """Sales inside a range of their country; one row per range that matches."""
    located = sales.filter(F.col("zipcode").isNotNull())
    return match_ranges(located, _lookup(geo), "inner", unique_by)


def first_city(sales: DataFrame, geo: DataFrame) -> DataFrame:
    """Every sale with the city of the first range that holds it, or null."""
    return match_ranges(sales, measure_ranges(first_match_ranges(geo)), "left")


def daily_demand(sales: DataFrame, geo: DataFrame | RangeLookup) -> DataFrame:
    """Sum of sales per city, product and day; junk and missing sales count as 0.

    With a broadcast range table the sum is combined map-side right after the join.
    Otherwise the rows must move for the join, so they are summed per code first: a hot
    code then holds at most one row per product and day.
    """
    lookup = _lookup(geo)
    clean = sales.select(
        "country",
        "zipcode",
        "product_id",
        "date",
        known_or_zero(lenient_double(F.col("sales"))).alias("sales"),
    )
    if not lookup.broadcasts:
        clean = clean.groupBy("country", "zipcode", "product_id", "date").agg(
            F.sum("sales").alias("sales")
        )
    return (
        zip_to_city(clean, lookup, unique_by=["product_id", "date"])
        .groupBy("city", "product_id", "date")
        .agg(F.sum("sales").alias("sales"))
    )
