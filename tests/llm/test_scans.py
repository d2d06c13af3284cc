import hashlib
import random

import pytest
from pyspark.sql import functions as F

from demandloom.llm.license_scan import TEMPLATES, cued_windows, fit_licenses, paragraphs, scan_licenses, words_of
from demandloom.llm.secret_scan import find_candidates, scan_secrets

SECRETS = "doc_id long, text string, source string"


def key(rng, n=40):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def secret_corpus(n=240, seed=1):
    rng = random.Random(seed)
    words = ["thenation", "erheble", "anding", "order", "number", "the", "of"]
    rows, keys = [], set()
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 40)))
        if i % 3 == 0:
            k = key(rng)
            keys.add(k)
            text += f' token = "{k}" ' + rng.choice(words)
        elif i % 3 == 1:
            text += f" card {rng.randrange(10**15, 10**16)} paid " + rng.choice(words)
        rows.append((i, text, f"src{i % 4}"))
    return rows, keys


def test_secrets_are_told_from_numbers(spark):
    rows, keys = secret_corpus()
    found = scan_secrets(spark.createDataFrame(rows, SECRETS)).collect()
    digests = {hashlib.sha256(k.encode()).hexdigest() for k in keys}
    assert len(found) == 160
    assert {r.digest for r in found if r.is_secret} == digests
    texts = {i: t for i, t, _ in rows}
    assert all(hashlib.sha256(texts[r.doc_id][r.start : r.start + r.length].encode()).hexdigest() == r.digest for r in found)


def test_own_labels_and_neighbours_hidden(spark):
    rows, keys = secret_corpus(seed=2)
    docs = spark.createDataFrame(rows, SECRETS)
    labelled = find_candidates(docs).withColumn("label", (F.length("candidate") == 40).cast("int"))
    # without a name before it, a key is still one by its letters
    rng = random.Random(9)
    other = [(i, f"see {key(rng)} there", "src1") for i in range(10)]
    scored = scan_secrets(spark.createDataFrame(other, SECRETS), labelled).collect()
    assert sum(r.is_secret for r in scored) >= 9


def test_what_is_assigned_to_a_secret_name_is_a_candidate_whatever_its_form(spark):
    text = """password = "hunter2!"
token = "abc123def456"; secret = 'abcdefghijklmnopqrstuvwx'
api_key = "sk.live.9f8e7d6c5b4a3f2e1d", db_password: p@ss/word,
pwd=x  AUTH_TOKEN = "with a space" plain = "abc" number 123456789012 id 1234567 passwords are fine"""
    found = find_candidates(spark.createDataFrame([(1, text, "s")], SECRETS)).collect()
    assert all(text[r.start :].startswith(r.candidate) for r in found)
    assert {r.candidate for r in found if r.named} == {
        "hunter2!", "abc123def456", "abcdefghijklmnopqrstuvwx", "sk.live.9f8e7d6c5b4a3f2e1d", "p@ss/word", "x", "with a space"
    }
    assert {r.candidate for r in found if not r.named} == {"123456789012"}


def test_recall_of_planted_keys_with_and_without_names(spark):
    rows, _ = secret_corpus(n=600, seed=5)
    rng = random.Random(11)
    planted = {}
    for i in range(200):
        k = key(rng) if i % 2 else "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(24))
        named = i % 4 < 2
        planted[hashlib.sha256(k.encode()).hexdigest()] = named
        rows.append((10_000 + i, f"text before {'secret = ' if named else 'and then '}{k} after it", "src2"))
    found = scan_secrets(spark.createDataFrame(rows, SECRETS)).collect()
    hit = {r.digest for r in found if r.is_secret}
    shares = [
        sum(d in hit for d, n in planted.items() if n == named) / sum(n == named for n in planted.values()) for named in (True, False)
    ]
    print("planted keys found, with names and without:", shares)
    assert shares[0] >= 0.95


def test_secret_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "nothing here", "a"), (4, "id 1234567890123456789", None),
            (4, "id 1234567890123456789", None), (None, "x" * 300_000 + "1", "a")]
    docs = spark.createDataFrame(rows, SECRETS).selectExpr("*", "1 as start", "'p' as path", "0 as score")
    found = scan_secrets(docs).collect()
    assert sorted((r.doc_id or 0, r.length, r.is_secret) for r in found) == [(0, 300_001, 0), (4, 19, 0), (4, 19, 0)]
    assert scan_secrets(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def model():
    return fit_licenses(["the of and thation erre nding with a number of words", "hello world again"] * 20)


def test_every_template_is_its_family(model):
    for family, templates in TEMPLATES.items():
        for template in templates:
            p = model.predict([words_of(template)])[0]
            assert model.families[p.argmax()] == family, template
            assert p.max() > 0.5


def test_licences_in_documents(spark):
    rows = [
        (1, "some text of it\n\nReleased under the MIT License.\nmore"),
        (2, "words before it and this work is licensed under the GNU General Public License, version 3. and words after " * 1),
        (3, "Licensed under the Zorblax Terms of Nine Moons."),
        (4, "a driver showed his license to the officer and drove on"),
        (5, None), (6, ""), (None, "Licensed under CC BY-NC 4.0."), (1, "some text of it\n\nReleased under the MIT License.\nmore"),
        (7, "word " * 30_000 + "\n \nLicensed under the Apache License, Version 2.0."), (8, "\n\n \n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as line", "'f' as family", "2 as words")
    found = {(r.doc_id, r.line): r for r in scan_licenses(docs).collect()}
    assert found[(1, 2)].family == "mit" and found[(2, 0)].family == "gpl"
    assert found[(None, 0)].family == "cc-by-nc" and found[(7, 2)].family == "apache-2.0"
    assert (3, 0) not in found or found[(3, 0)].family == "unknown"
    assert (4, 0) not in found or not found[(4, 0)].confirmed
    assert {k[0] for k in found} <= {1, 2, 3, 4, 7, None}
    assert scan_licenses(docs.limit(0)).count() == 0


MIT = TEMPLATES["mit"][1]
APACHE = TEMPLATES["apache-2.0"][1]


def test_notices_of_two_licences_in_one_line_are_both_found(spark):
    rows = [(1, f"{TEMPLATES['apache-2.0'][0]} {MIT}"), (2, f"{APACHE} {MIT}"), (3, f"{MIT} {'word ' * 200}{APACHE}")]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).where("confirmed").collect()
    for doc in (1, 2, 3):
        assert {r.family for r in found if r.doc_id == doc} == {"mit", "apache-2.0"}, doc


def test_wrapped_notices_are_found(spark):
    rows = [(1, "Permission\nis hereby granted, free of charge, to any\nperson obtaining a copy of this software and\nassociated documentation files"),
            (2, "\n".join(APACHE.split()))]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).where("confirmed").collect()
    assert {(r.doc_id, r.family) for r in found} == {(1, "mit"), (2, "apache-2.0")}


def test_every_template_has_a_cue_and_edited_copies_mostly():
    rng = random.Random(4)
    kept = total = 0
    for templates in TEMPLATES.values():
        for template in templates:
            assert cued_windows(template)
            for _ in range(50):
                words = [w for w in template.split() if rng.random() > 0.08] or template.split()
                total += 1
                kept += bool(cued_windows(" ".join(words)))
    print("edited templates with a cue:", kept / total)
    assert kept / total > 0.9


def test_paragraphs():
    assert paragraphs("a\nb\n\n\n c \nd\n \n") == [(0, "a b"), (4, " c  d")]
    assert paragraphs("\n\n") == [] and paragraphs("x") == [(0, "x")]
