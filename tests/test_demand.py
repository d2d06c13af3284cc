import random

import pytest
from helpers import P1, day, values

from demandloom import schemas
from demandloom.operators import demand
from demandloom.operators.ranges import first_match_ranges, match_ranges, measure_ranges

GEO = [
    ("M", 2984000, 3355000, "M"),
    ("B", 2984000, 3355000, "B3"),
    ("B", 24003900, 24900001, "B3"),
    ("B", 86380000, 86600001, "B3"),
]


def geo_of(spark, rows):
    return spark.createDataFrame(rows, schemas.GEO)


def sales_of(spark, rows):
    return spark.createDataFrame(rows, schemas.SALES)


def lookups(geo):
    """The broadcast way, and the way taken when the ranges are too large for it."""
    return [measure_ranges(geo), measure_ranges(geo, broadcast_rows=0, pieces=5)]


def test_daily_demand(spark):
    sales = sales_of(
        spark,
        [
            ("B", P1, day("2024-08-01"), 86400000, "1.0"),
            ("B", P1, day("2024-08-01"), 3121020, "xfff"),
            ("B", P1, day("2024-08-07"), 24725060, "NaN"),
            ("B", P1, day("2024-08-07"), 86400000, "9999"),
            ("B", P1, day("2024-08-07"), None, "5"),
            ("C", P1, day("2024-08-07"), 3121020, "5"),
        ],
    )
    for lookup in lookups(geo_of(spark, GEO)):
        assert values(demand.daily_demand(sales, lookup)) == [
            ("B3", P1, day("2024-08-01"), 1.0),
            ("B3", P1, day("2024-08-07"), 9999.0),
        ]


def test_ranges_are_half_open(spark):
    geo = geo_of(spark, [("B", 10, 20, "X")])
    sales = sales_of(spark, [("B", P1, day("2024-08-01"), z, "1") for z in (9, 10, 19, 20, None)])
    for lookup in lookups(geo):
        assert values(demand.zip_to_city(sales, lookup), "zipcode") == [(10,), (19,)]


def test_sales_text_that_is_not_a_finite_number(spark):
    geo = geo_of(spark, [("B", 0, 9, "X")])
    texts = ["1e3", " 2 ", "NaN", "", None, "12a", "-4"]
    sales = sales_of(spark, [("B", P1, day("2024-08-01"), 1, t) for t in texts])
    assert values(demand.daily_demand(sales, geo), "sales") == [(998.0,)]


def test_city_list(spark):
    geo = geo_of(spark, GEO)
    assert demand.keep_cities(geo, ["B3"]).count() == 3
    assert demand.keep_cities(geo, None).count() == 4


def test_empty_geo(spark):
    sales = sales_of(spark, [("B", P1, day("2024-08-01"), 1, "1")])
    for lookup in lookups(geo_of(spark, [])):
        assert demand.daily_demand(sales, lookup).count() == 0
        assert values(match_ranges(sales, lookup, "left"), "zipcode", "city") == [(1, None)]


def random_case(seed):
    """Overlapping, empty, negative and very wide ranges, and one hot code."""
    rng = random.Random(seed)
    ranges = []
    for i in range(60):
        start = rng.randint(-200, 1000)
        width = rng.choice([0, 1, 2, 7, 8, 9, 40, 500, 100_000])
        ranges.append((rng.choice("BM"), start, start + width, f"c{i}"))
    points = [(rng.choice("BMC"), rng.choice([None, *range(-250, 1200)])) for _ in range(400)]
    points += [("B", 42)] * 300
    return ranges, points


@pytest.mark.parametrize("seed", [1, 2])
def test_range_match_against_brute_force(spark, seed):
    ranges, points = random_case(seed)
    sales = sales_of(spark, [(c, P1, day("2024-08-01"), z, "1") for c, z in points])
    every = [
        (c, z, city)
        for c, z in points
        if z is not None
        for k, s, e, city in ranges
        if k == c and s <= z < e
    ]
    first = []
    ordered = sorted(ranges, key=lambda r: (r[0], r[1], r[3]))
    for c, z in points:
        hits = [r[3] for r in ordered if z is not None and r[0] == c and r[1] <= z < r[2]]
        first.append((c, z, hits[0] if hits else None))

    def key(row):
        return tuple((v is not None, str(v)) for v in row)

    geo = geo_of(spark, ranges)
    for lookup in lookups(geo):
        found = demand.zip_to_city(sales, lookup)
        assert values(found, "country", "zipcode", "city") == sorted(every, key=key)
    chunked = lookups(first_match_ranges(geo, chunk_bits=5))
    for lookup in lookups(first_match_ranges(geo)) + chunked:
        found = match_ranges(sales, lookup, "left")
        assert values(found, "country", "zipcode", "city") == sorted(first, key=key)


def test_large_ranges_are_not_broadcast(spark):
    geo, sales = geo_of(spark, GEO), sales_of(spark, [("B", P1, day("2024-08-01"), 3121020, "1")])
    small, large = lookups(geo)
    assert small.broadcasts and not large.broadcasts
    assert not measure_ranges(geo, broadcast_bytes=10).broadcasts
    plan = demand.daily_demand(sales, small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [country" in plan and "NestedLoop" not in plan
    plan = demand.daily_demand(sales, large)._jdf.queryExecution().executedPlan().toString()
    # only the hot codes, fewer than the pieces asked for, are broadcast
    assert "s_zipcode" in plan and "BroadcastHashJoin [country" in plan
    for line in plan.splitlines():
        assert not ("BroadcastHashJoin" in line and "_shift" in line)


def test_copies_of_a_hot_code_are_spread_and_kept(spark):
    geo = geo_of(spark, [("B", 0, 10, "X"), ("B", 5, 20, "Y")])
    rows = [("B", P1, day("2024-08-01"), 7, "1")] * 500 + [("B", P1, day("2024-08-01"), None, "1")] * 300
    rows += [("B", P1, day("2024-08-01"), 60, "2")] * 3
    sales = sales_of(spark, rows)
    lookup = measure_ranges(geo, broadcast_rows=0, pieces=10)
    assert sorted(
        (r["zipcode"] or 0, r["city"] or "", r["count"])
        for r in match_ranges(sales, lookup, "left").groupBy("zipcode", "city").count().collect()
    ) == [(0, "", 300), (7, "X", 500), (7, "Y", 500), (60, "", 3)]
