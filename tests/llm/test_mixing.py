import random

from pyspark.sql import functions as F

from demandloom.llm.mixing import mix, mixed_documents, source_targets

SCHEMA = "doc_id long, text string, source string"


def targets(sizes, weights=(5, 2, 1), most=3):
    """By the rule: share by weight, stop the full ones, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] >= most * sizes[s]]
        if not over:
            return full | share
        full |= {s: most * sizes[s] for s in over}
        if len(full) == len(names):
            return full


def test_targets_are_shared_by_weight_until_none_is_above(spark):
    rng = random.Random(2)
    for _ in range(5):
        sizes = {s: rng.choice([0, 3, 50, 1000, 40_000]) for s in ["b", "a", "Z", "é", "c", None]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in source_targets(df).collect()}
        expected = targets(sizes)
        assert all(abs(found[s] - expected[s]) <= 1e-6 * max(1, expected[s]) for s in sizes)


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "tiny"])
        rows.append((i, " ".join(["w"] * int(rng.paretovariate(1.2) * 10)), source))
    return rows


def test_words_taken_are_near_the_targets(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r for r in mix(docs).collect()}
    assert len(found) == len(rows)
    sizes, taken = {}, {}
    for i, text, source in rows:
        r = found[i]
        assert r["size"] == len(text.split()) and r.taken == r["size"] * r.copies and 0 <= r.copies <= 3
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    expected = targets(sizes)
    for i, _, source in rows:
        assert found[i].source_size == sizes[source] and abs(found[i].target - expected[source]) < 1e-6 * expected[source] + 1e-6
    assert all(abs(taken[s] - expected[s]) <= 0.01 * expected[s] for s in sizes)
    # the tilt: rates are exp(multiplier * size), cut at three
    of_a = sorted({(found[i]["size"], found[i].rate) for i, _, s in rows if s == "a"})
    rates = [rate for _, rate in of_a]
    assert rates == sorted(rates) or rates == sorted(rates, reverse=True)


def test_reruns_and_other_partitions_agree(spark):
    docs = spark.createDataFrame(corpus(3), SCHEMA)
    first = sorted(tuple(r) for r in mix(docs).collect())
    assert first == sorted(tuple(r) for r in mix(docs.repartition(7, F.rand(5))).collect())


def test_nulls_blanks_repeats_and_empty_tables(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n", None), (4, "x y z", "a"), (4, "x y z", "a"), (None, "p q", "b"), (5, None, "only")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "9 as size", "'n' as n", "0 as copies", "0 as rate")
    found = mix(docs).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in found) == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 3), (4, 3), (5, 0)]
    assert all(r.taken == 0 for r in found if not r["size"])
    assert mix(docs.limit(0)).count() == 0
    taken = mixed_documents(docs)
    assert "text" in taken.columns and taken.where("taken > 3 * size").count() == 0


def test_one_source_keeps_its_size(spark):
    docs = spark.createDataFrame([(i, "w " * (i + 1), "s") for i in range(30)], SCHEMA)
    assert sum(r.taken for r in mix(docs).collect()) == sum(range(1, 31))


def test_documents_of_one_size_in_parts_are_taken_as_often(spark, monkeypatch):
    from demandloom.llm import mixing

    rows = [(i, "same words in all of them", f"s{i % 3}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def copies():
        return sorted(tuple(r) for r in mixing.mix(docs).groupBy("target", "copies").count().collect())

    whole = copies()
    monkeypatch.setattr(mixing, "PART", 4)
    assert copies() == whole


def test_rates_solve_each_sources_dual(spark):
    """The tilt against a bisection in plain Python: sum of size * min(3, exp(k * size)) is the target."""
    import math

    rows = corpus(seed=4)
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by_source = {}
    sources = {r[0]: r[2] for r in rows}
    for r in found:
        by_source.setdefault(sources[r.doc_id], []).append(r)
    checked = 0
    for own in by_source.values():
        sizes, target = [r.size for r in own if r.size], own[0].target
        if not sizes:
            continue

        def words(k):
            return sum(s * min(3.0, math.exp(min(k * s, 50.0))) for s in sizes)

        low, high = -50.0, 50.0
        for _ in range(200):
            low, high = ((low + high) / 2, high) if words((low + high) / 2) < target else (low, (low + high) / 2)
        if words(high) < target * (1 - 1e-6):  # every document three times and still too few
            continue
        for r in own:
            if r.size:
                expected = min(3.0, math.exp(min(high * r.size, 50.0)))
                assert abs(r.rate - expected) < 1e-3 * max(1.0, expected), (r, expected)
                checked += 1
    assert checked > 100
