"""Collocations against plain Python that counts every phrase."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from demandloom.llm import collocations as module
from demandloom.llm.collocations import collocations, frequent_phrases

SCHEMA = "doc_id long, lang string, text string, phrase string"


def occurrences(rows, longest):
    counts, totals = defaultdict(Counter), Counter()
    for _, lang, text, *_ in rows:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und" if lang is None else lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + n])] += 1
    return counts, totals


def brute(rows, longest=3, support=10, most=2000, absorbed=50):
    counts, totals = occurrences(rows, longest)
    found = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        held = Counter()
        for p, a in frequent.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    held[p[i : i + n]] = max(held[p[i : i + n]], a)
        best = []
        for p, a in frequent.items():
            if p in held and 100 * held[p] >= absorbed * a:
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:most], 1):
            found.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def found(df, **params):
    return sorted(tuple(r) for r in collocations(df, **params).collect())


ROWS = [
    *[(i, "en", f"New York City, is not new york; {'the big' if i % 3 else 'a Big'} apple\tpie\npie", "x") for i in range(30)],
    *[(i, None, "Été  indien. Été indien! aa aa aa aa", "x") for i in range(6)],
    *[(i, "und", "aa aa", None) for i in range(4)],
    *[(i, "en", None, None) for i in range(3)],
    (99, "en", "", "x"),
    (None, "", "one of its own language " * 15, "x"),
    (98, "de", "a b " * 30000, "x"),
    (97, "fr", " .;\n\t ", "x"),
]


@pytest.mark.parametrize(("parts", "shards"), [(1, 4), (7, 1), (7, 4), (5, 10)])
def test_equals_brute_force(spark, parts, shards):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(parts)
    assert found(df, shards=shards) == brute(ROWS)


@pytest.mark.parametrize(("longest", "support", "absorbed"), [(2, 3, 50), (4, 5, 90), (5, 12, 101)])
def test_other_lengths(spark, longest, support, absorbed):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    expected = brute(ROWS, longest=longest, support=support, absorbed=absorbed)
    assert found(df, longest=longest, support=support, absorbed=absorbed, shards=3) == expected


def test_first_of_each_language(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert found(df, most=2) == brute(ROWS, most=2)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_phrases_spread_thinly_over_shards_are_found(spark):
    # ten occurrences in ten partitions: one in each, and in each shard the least that counts
    rows = [(i, "en", f"w{i} rare phrase z{i}", None) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA).repartitionByRange(10, "doc_id")
    assert ("en", "rare phrase", 2, 10) in {tuple(r) for r in frequent_phrases(df, 3, 10, 4).collect()}


def test_more_shards_than_support_is_an_error(spark):
    with pytest.raises(ValueError):
        frequent_phrases(spark.createDataFrame([], SCHEMA), 3, 2, 4)


def test_bitmap_holds_every_frequent_phrase(spark):
    rows = [(i, "en", f"w{i % 50} x{i % 7}", None) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).select("lang", "text")
    found = module.candidates(df, 2, 8, 2)

    def held(*words):
        hashes = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in words], np.uint64)
        return bool(found.hold(module._keys("en", hashes, np.arange(len(words))[None]))[0])

    counts, _ = occurrences(rows, 2)
    assert all(held(*p) for p, n in counts["en"].items() if n >= 8)
    assert sum(held(f"other{i}") for i in range(10000)) < 10


@pytest.mark.parametrize("name", ["MERGED", "BUCKET_BYTES", "SLICE_BYTES", "BITS"])
def test_sizes_change_no_result(spark, monkeypatch, name):
    monkeypatch.setattr(module, name, {"BITS": 5}.get(name, 64))
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert found(df) == brute(ROWS)
