import pytest
from helpers import P1, P2, day, values

from demandloom import schemas
from demandloom.operators import demand, quality

# 2024-08-05 is a Monday
ROWS = [
    ("B", P1, day("2024-08-05"), 1, "9999"),
    ("B", P1, day("2024-08-05"), 1, "9999"),
    ("B", P1, day("2024-08-06"), 2, "9999.0"),
    ("B", P2, day("2024-08-06"), 2, "xfffx"),
    ("B", P2, day("2024-08-06"), 5, None),
    ("B", P2, day("2024-08-06"), 50, "3"),
    ("C", P2, day("2024-08-06"), 1, "4"),
    ("B", P2, day("2024-08-06"), None, "4"),
]


def frames(spark):
    sales = spark.createDataFrame(ROWS, schemas.SALES)
    geo = spark.createDataFrame([("B", 0, 2, "X"), ("B", 2, 10, "Y"), ("M", 0, 9, "Z")], schemas.GEO)
    return sales, geo, demand.zip_to_city(sales, geo)


def test_values_and_weekdays(spark):
    sales, _, located = frames(spark)
    assert values(quality.junk_values(sales)) == [("xfffx", 1)]
    assert values(quality.sales_by_weekday(located)) == [(0, 19998.0), (1, 9999.0)]
    assert [tuple(r) for r in quality.value_frequency(located).collect()] == [
        ("9999", 2, 40.0),
        ("9999.0", 1, 20.0),
        ("nan", 1, 20.0),
        ("xfffx", 1, 20.0),
    ]


def test_share_at_the_cap(spark):
    located = frames(spark)[2]
    assert values(quality.cap_share(located, ["zipcode"])) == [(1, 2, 2, 1.0), (2, 2, 1, 0.5), (5, 1, 0, 0.0)]
    weekday = quality.cap_share(located.filter("zipcode = 5"), ["weekday"], zero_when_absent=False)
    assert values(weekday) == [(1, 1, None, None)]
    by_series = quality.cap_share(located, ["city", "product_id"], of_values=True)
    assert values(by_series) == [("X", P1, 2, 2, 1.0), ("Y", P1, 1, 1, 1.0), ("Y", P2, 0, 0, None)]
    counts = quality.capped_keys(located, (["zipcode"], ["product_id"], ["city", "product_id"]))
    assert values(counts) == [("city+product_id", 2), ("product_id", 1), ("zipcode", 2)]


def test_coverage(spark):
    sales, geo, located = frames(spark)
    assert values(quality.unmatched_share(demand.first_city(sales, geo))) == [(3, 37.5)]
    assert values(quality.series_coverage(sales, geo, located)) == [(6, 3, 50.0)]


def test_profiles(spark):
    sales = frames(spark)[0]
    profile = {r["column"]: r for r in quality.profile_columns(sales).collect()}
    assert profile["sales"].asDict() == {
        "column": "sales",
        "rows": 8,
        "missing": 1,
        "missing_pct": 12.5,
        "distinct": 5,
        "min": "3",
        "max": "xfffx",
    }
    assert profile["zipcode"]["max"] == "50" and profile["date"]["min"] == "2024-08-05"
    rough = {r["column"]: r["distinct"] for r in quality.profile_columns(sales, approximate=True).collect()}
    assert rough["country"] == 2
    assert values(quality.duplicate_rate(sales)) == [(8, 1, 12.5)]
    assert values(quality.numeric_profile(sales), "column", "zeros") == [("zipcode", 0)]


def test_profiles_of_nothing(spark):
    empty = frames(spark)[0].limit(0)
    assert values(quality.duplicate_rate(empty)) == [(0, 0, None)]
    assert quality.profile_columns(empty).filter("missing_pct is null").count() == 5


def test_sketches_of_parts_merge_into_the_profile_of_the_whole(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(int(v), float(v) if v % 50 else None, f"t{v % 3000}") for v in rng.integers(0, 40000, 20000)]
    df = spark.createDataFrame(rows, "a long, b double, c string").repartition(5)
    whole = quality.profile_sketches(df)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    parts = quality.profile_sketches(df.where("a < 10000")).unionByName(quality.profile_sketches(df.where("a >= 10000")))
    exact = {"a": len({r[0] for r in rows}), "b": len({r[1] for r in rows if r[1] is not None}), "c": len({r[2] for r in rows})}
    ordered = {"a": sorted(r[0] for r in rows), "b": sorted(r[1] for r in rows if r[1] is not None)}
    for sketches in (whole, quality.merge_sketches(parts)):
        profile = quality.sketched_profile(sketches).collect()
        assert {r["column"] for r in profile} == {"a", "b", "c"}
        for r in profile:
            assert r["rows"] == 20000
            assert r["missing"] == (sum(x[1] is None for x in rows) if r["column"] == "b" else 0)
            assert abs(r["distinct"] - exact[r["column"]]) <= quality.DISTINCT_ERROR * exact[r["column"]]
            if r["column"] == "c":
                assert r["quantile"] is None and r["value"] is None
            else:
                v = ordered[r["column"]]
                assert abs(np.searchsorted(v, r["value"], "right") / len(v) - r["quantile"]) <= quality.RANK_ERROR


def test_sketches_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a long, c string")
    profile = quality.sketched_profile(quality.profile_sketches(empty))
    assert sorted((r["column"], r["rows"], r["missing"], r["distinct"], r["value"]) for r in profile.collect()) == [
        ("a", 0, 0, 0, None), ("c", 0, 0, 0, None)
    ]


def test_correlations(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0), (3, None, 5.0), (4, 8.0, 5.0)], "x long, y double, z double")
    found = {(r["left"], r["right"]): r["value"] for r in quality.correlations(df).collect()}
    assert found[("x", "y")] == pytest.approx(1.0)
    assert found[("x", "z")] is None and found[("y", "z")] is None
    with pytest.raises(ValueError):
        quality.correlations(df.select("x"))
