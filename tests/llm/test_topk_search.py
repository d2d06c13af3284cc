import math
import random

from demandloom.llm.topk_search import top_k

SCHEMA = "vec_id long, embedding array<float>"


def terms(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * x) for x in vector]


def brute(rows, k=5):
    known = [(i, terms(v)) for i, v in rows if i is not None and terms(v) is not None]
    out = []
    for q, a in known:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in known if i != q)
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'s' as score", "1 as rank", "2 as query_id")
    return sorted(tuple(r) for r in top_k(df, df.where("vec_id % 50 = 0"), **more).collect())


def test_equals_brute_force_with_ties(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.7]) for _ in range(6)]) for i in range(400)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, group=3) == brute(rows)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (50, None), (100, [1.0, float("nan")]), (1, [None, 1.0]), (2, [float("inf"), 1.0]),
            (3, [0.5, -0.5]), (None, [9.0, 9.0]), (4, [1.0]), (5, []), (150, [0.001, -0.001])]
    assert found(spark, rows) == brute(rows)


def test_large_weights_are_exact(spark):
    rows = [(0, [3e6, 1.0, -2.5e6]), (1, [3e6, 0.004, 3e6]), (2, [3e6, 0.008, 3e6]), (50, [1e3, 1.0, 1.0])]
    assert found(spark, rows) == brute(rows)


def test_fewer_candidates_repeats_and_empty_tables(spark):
    assert found(spark, [(0, [1.0])]) == []
    rows = [(0, [1.0]), (7, [1.0]), (7, [1.0])]
    assert found(spark, rows) == [(0, 1, 7, 65536), (0, 2, 7, 65536)]
    assert found(spark, []) == []
