"""Token counts against the library, and what the cache holds."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandloom.llm.durable import fresh
from demandloom.llm.token_counts import token_counts
from demandloom.llm.tokenizers import TokenizerFile

PATH = public_tokenizers.path("word_bpe_49k.json")
WORDS = TokenizerFile.read(PATH)
SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    (1, "Some words"),
    (2, "Some \n words"),
    (3, "SOME words"),
    (4, None),
    (5, ""),
    (5, ""),
    (6, "<|endoftext|> <|ENDOFTEXT|>\n<|startoftext|>"),
    (7, "été 漢字 \U0001f600 \x00 \x0b\x0c"),
    (None, "no id"),
    (None, "no id"),
    (8, "it's 123 " * 4000),
]


def brute(rows):
    tokenizer = Tokenizer.from_file(PATH)
    counted = []
    for doc_id, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        counted.append((doc_id, len((text or "").encode()), n, n > 2048))
    return sorted(counted, key=str)


def found(df, cache, tokenizer=WORDS):
    return sorted((tuple(r) for r in token_counts(df, tokenizer, cache, 2048).collect()), key=str)


def test_equals_the_library_and_encodes_distinct_misses_only(spark):
    cache = fresh(spark, "cache")
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    assert found(df.limit(0), cache) == []
    assert found(df, cache) == brute(TEXTS)
    # spaces and line ends count as one another; case does not, for special tokens have one
    held = spark.read.parquet(cache).count()
    assert held == 7
    assert found(df, cache) == brute(TEXTS)
    assert spark.read.parquet(cache).count() == held
    more = [*TEXTS, (9, "new")]
    assert found(spark.createDataFrame(more, "doc_id long, text string"), cache) == brute(more)
    assert spark.read.parquet(cache).count() == held + 1


def test_counts_come_from_the_cache_and_repeated_entries_count_once(spark):
    cache = fresh(spark, "cache")
    df = spark.createDataFrame([(1, "one text")], "doc_id long, text string")
    found(df, cache)
    entry = spark.read.parquet(cache).collect()
    told = spark.createDataFrame([(WORDS.version, entry[0]["digest"], 77)] * 2, "version string, digest binary, n_tokens long")
    other = fresh(spark, "cache")
    told.write.parquet(other)
    assert found(df, other) == [(1, 8, 77, False)]


def test_versions_do_not_meet(spark):
    cache = fresh(spark, "cache")
    df = spark.createDataFrame(TEXTS[:3], "doc_id long, text string")
    found(df, cache)
    pieces = TokenizerFile.read(public_tokenizers.path("piece_bpe_32k.model"))
    counted = found(df, cache, pieces)
    assert [r[2] for r in counted] == [len(pieces.encode([t])[0]) for _, t in TEXTS[:3]]
    assert spark.read.parquet(cache).select("version").distinct().count() == 2


@pytest.mark.parametrize("name", ["documents"])
def test_given_documents(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs.withColumn("digest", docs.source), fresh(spark, "cache")) == brute(rows)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_parts_have_the_tokens_of_the_text(spark, name):
    tokenizer = TokenizerFile.read(public_tokenizers.path(name))
    texts = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    texts += [t for _, t in TEXTS if t] + ["a b", "a  b", " a b ", "é b c", "b é", "á b ́c", "it 's I ll", "x <|endoftext|> y z", "a.b,c-d(e)f_g/h1i2", "a.\tb", "l'été.d'un 's 'x", "it's.'s", "ΑΣ Σ", "e\u0301 a\u0301b", "x²½Ⅷ9٣y", "straße İI ǅ"]
    for text in texts:
        for parts in (tokenizer.at_seams(text), tokenizer.words(text)):
            together = [i for e in tokenizer.encode(parts) for i in tokenizer.ids_of(e)]
            assert together == list(tokenizer.ids_of(tokenizer.encode([text])[0]))


def test_counts_without_memory_are_the_same(spark, monkeypatch):
    import demandloom.llm.token_counts as module

    monkeypatch.setattr(module, "KNOWN_PARTS", 0)
    monkeypatch.setattr(module, "SLICE_BYTES", 10)
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert found(df, fresh(spark, "cache")) == brute(TEXTS)
