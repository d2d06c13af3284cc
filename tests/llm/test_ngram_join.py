import random
import re

import pytest

from demandloom.llm.ngram_join import drop_near_copies, ngram_components, ngram_links

SCHEMA = "doc_id long, text string"


def shingles(text, width=5):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, num=80):
    sets = {i: shingles(t) for i, t in rows}
    links = {
        (a, b)
        for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    }
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return sets, links, root


def varied(seed=1, bases=6, copies=9, words=60):
    """Near copies of different closeness, chains, short and shared texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)]
    rows, i = [], 0
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for k in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = f"x{i}"
            if k == 0:
                text += [rng.choice(vocabulary) for _ in range(5)]
            base = text if rng.random() < 0.5 else base
            rows.append((i, rng.choice([" ", "\n", "\t "]).join(text)))
            i += 1
    common = " ".join(vocabulary[:30])
    rows += [(i + k, f"{common} tail{k}") for k in range(5)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "one two"), (904, "ONE  two"), (905, "one two three"),
             (906, "é É"), (907, "é é"), (908, "a b c d e"), (909, "a b c d e a b c d e")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = varied(seed)
    sets, _, root = brute(rows)
    found = {r.doc_id: r for r in ngram_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in found.items()} == root


def test_links_lose_nothing_between_different_texts(spark):
    rows = varied(3)
    sets, links, _ = brute(rows)
    found, member = ngram_links(spark.createDataFrame(rows, SCHEMA))
    of = {r.doc_id: r.class_id for r in member.collect()}
    wanted = {(min(of[a], of[b]), max(of[a], of[b])) for a, b in links if of[a] != of[b]}
    got = found.collect()
    assert {(r.a, r.b) for r in got} == wanted and len(got) == len(wanted)
    assert all(r.overlap == len(sets[r.a] & sets[r.b]) for r in got)
    assert all(of[i] is None for i in (900, 901, 902))


def test_exact_threshold(spark):
    # 8 of 10 shingles in common: exactly 80 percent
    common = [f"c{i}" for i in range(12)]
    rows = [(1, " ".join(common + ["x"])), (2, " ".join(common + ["y"]))]
    sets, links, _ = brute(rows)
    assert len(sets[1] & sets[2]) == 8 and len(sets[1] | sets[2]) == 10 and links
    found = ngram_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component_id for r in found} == {1}


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(100)] = f"z{i}"
        rows.append((i, " ".join(text)))
    found = ngram_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component_id for r in found} == {0}


def test_repeated_rows_missing_ids_empty_tables_and_other_columns(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'n' as n", "'g' as gram", "'c' as component")
    found = sorted((r.doc_id, r.component_id) for r in ngram_components(docs).collect())
    assert found == [(1, 1), (1, 1), (2, 1)]
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1]
    none = spark.createDataFrame([], SCHEMA)
    assert ngram_components(none).count() == 0
    assert drop_near_copies(none).count() == 0


def test_a_very_long_text(spark):
    text = " ".join(f"w{i % 70000}" for i in range(300_000))
    rows = [(1, text), (2, text + " end"), (3, "w1 w2 w3 w4 w5")]
    found = {r.doc_id: r.component_id for r in ngram_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
