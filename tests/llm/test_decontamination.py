import random

from demandloom.llm.decontamination import best_end, contaminated, drop_contaminated, normalised

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def sellers(pattern, text):
    row, best = list(range(len(pattern) + 1)), len(pattern)
    for c in text:
        before, row[0] = row[0], 0
        for i in range(1, len(pattern) + 1):
            now = min(row[i] + 1, row[i - 1] + 1, before + (pattern[i - 1] != c))
            before, row[i] = row[i], now
        best = min(best, row[-1])
    return best


def edited(rng, text, edits):
    x = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(x)), rng.randrange(3)
        if kind == 0:
            x[at] = rng.choice("abé ")
        elif kind == 1:
            del x[at]
        else:
            x.insert(at, rng.choice("xyz "))
    return "".join(x)


def test_distance_is_that_of_dynamic_programming():
    rng = random.Random(2)
    for _ in range(60):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        masks = {}
        for i, c in enumerate(p):
            masks[c] = masks.get(c, 0) | 1 << i
        assert best_end(masks, len(p), t)[0] == sellers(p, t)


def test_matches_equal_brute_force(spark):
    rng = random.Random(4)
    words = ["the", "of", "ation", "there", "bleand", "osting", "wh", "ndin"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(6, 30))).capitalize()) for i in range(12)]
    docs = []
    for d in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 2)):
            text = rng.choice(items)[1]
            parts.append(edited(rng, text, rng.randint(0, len(text) // 8)).upper())
        docs.append((d, rng.choice([" ", "\n", "  "]).join(parts)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (102, items[1][1]), (102, items[1][1])]
    expected = []
    for d, text in docs:
        for i, item in items:
            p, t = normalised(item), normalised(text or "")
            best = sellers(p, t) if len(p) >= 20 else len(p)
            if best <= int(0.1 * len(p)) and len(p) >= 20:
                expected.append((d, i, best, len(p)))
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as item_id", "2 as distance")
    found = contaminated(df, spark.createDataFrame([*items, items[0], (99, None), (98, "short")], ITEMS))
    assert sorted((tuple(r)[:4] for r in found.collect()), key=str) == sorted(expected, key=str)


def test_documents_with_items_go(spark):
    item = "a passage of a benchmark that nobody should train on, ever"
    docs = spark.createDataFrame([(1, "x " + item), (2, "clean"), (3, None), (None, "clean too")], DOCS)
    benchmark = spark.createDataFrame([(1, item)], ITEMS)
    kept = drop_contaminated(docs.selectExpr("*", "7 as item_id"), benchmark)
    assert kept.columns == ["doc_id", "text", "item_id"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3]
    none = spark.createDataFrame([], ITEMS)
    assert contaminated(docs, none).count() == 0 and drop_contaminated(docs, none).count() == 4
    assert contaminated(docs.limit(0), benchmark).count() == 0
