"""Alignment against plain Python that intersects sets of offsets."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandloom.llm import token_alignment as module
from demandloom.llm.token_alignment import aligned, pair_counts, shared_cuts, token_alignment
from demandloom.llm.tokenizers import TokenizerFile

A = TokenizerFile.read(public_tokenizers.path("byte_bpe_50k.json"), special_as_text=True)
B = TokenizerFile.read(public_tokenizers.path("piece_bpe_32k.model"))
SF_DIR = "/root/testdata/sf0.001"

TEXTS = [
    (1, "Plain words, then some more of them."),
    (2, "Plain words, then some more of them."),
    (3, None),
    (4, ""),
    (5, "<|endoftext|> and <s> are plain text </s>"),
    (6, "with ▁ the tokens of one side spell another text"),
    (7, "été 漢字かな 😀 ﬁ Ǻ ​"),
    (8, "a  b\tc\n\n d \r\n   "),
    (9, " "),
    (10, "x" * 5000 + " 0123456789" * 300),
    (None, "no id"),
    (12, "\x00 nul"),
]


def expected(rows):
    bytes_a, bytes_b = A.token_bytes(), B.token_bytes()
    docs = []
    for doc_id, text in rows:
        a = A.ids_of(A.encode([" " + text])[0]) if text else []
        b = B.ids_of(B.encode([text])[0]) if text else []
        wanted = b" " + (text or "").encode()
        if b"".join(bytes_a[i] for i in a) != wanted or b"".join(bytes_b[i] for i in b) != wanted:
            a, b = [], []
        ends_a = np.cumsum([len(bytes_a[i]) for i in a]).tolist()
        ends_b = np.cumsum([len(bytes_b[i]) for i in b]).tolist()
        groups, links, at_a, at_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            links.append((a[to_a - 1], b[to_b - 1]))
            at_a, at_b = to_a, to_b
        docs.append((doc_id, len(a), len(b), groups, links))
    counts = Counter(pair for *_, links in docs for pair in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    return sorted(
        (
            (
                doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links),
                sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc_id, n_a, n_b, groups, links in docs
        ),
        key=str,
    )


def found(df):
    return sorted((tuple(r) for r in token_alignment(df, A, B).collect()), key=str)


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_brute_force(spark, parts):
    rows = TEXTS + TEXTS[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert found(df) == expected(rows)


def test_table_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "some text", 5, "x")], "doc_id long, text string, n_a long, links string")
    assert found(df) == expected([(1, "some text")])


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert found(docs) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_few_links_at_once(spark, monkeypatch):
    monkeypatch.setattr(module, "LOOKED_UP", 3)
    monkeypatch.setattr(module, "SLICE_BYTES", 40)
    monkeypatch.setattr(module, "TOGETHER", 2)
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").coalesce(2)
    assert found(df) == expected(TEXTS)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def test_linked_pairs_are_bounded_by_the_vocabularies(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bytes_a, bytes_b = A.token_bytes(), B.token_bytes()
    for row in pair_counts(aligned(docs, A, B)).collect():
        a, b = bytes_a[row["pair"] & 0xFFFFFFFF], bytes_b[row["pair"] >> 32]
        assert a.endswith(b) or b.endswith(a)


steps = st.lists(st.integers(1, 6), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(steps, steps), min_size=1, max_size=4))
def test_cuts_are_the_common_ends(texts):
    ends, docs, total = ([], []), ([], []), 0
    for pair in texts:
        longest = max(sum(s) for s in pair)
        for side, s in enumerate(pair):
            own = np.cumsum(s)
            own[-1] = longest
            ends[side].extend((total + own).tolist())
            docs[side].append(len(ends[side]))
        total += longest
    common = sorted(set(ends[0]) & set(ends[1]))
    a, b = shared_cuts(*(np.array(x) for x in ends), *(np.array(x) for x in docs))
    assert [ends[0][i] for i in a] == common == [ends[1][i] for i in b]


@pytest.mark.parametrize("cut", [True, False])
def test_parts_align_as_whole_texts(spark, monkeypatch, cut):
    monkeypatch.setattr(module, "KNOWN_PARTS", 400)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()][:60]
    odd = ["a.b c, d", "a ... b", "x., y!? z", "é. ñ, 1. 2", " lead", "trail ", "a\u00a0. b", "²! ½.", "▁ good words", "a▁. b", "a. \x01. b.", "x ... y... z", "\x01", "a.. . b"]
    odd += [t for _, t in TEXTS if t and len(t) < 100]
    rows += [(10**6 + i, t) for i, t in enumerate(odd)]
    pair = module._Pair(A, B)
    assert pair.cut and pair.marks_apart
    pair.cut = pair.marks_apart = cut
    wanted = {r[0]: r for r in expected(rows)}
    for start in range(0, len(rows), 25):
        some = rows[start : start + 25]
        for (doc_id, _), found_ in zip(some, pair.aligned([t for _, t in some])):
            assert found_[:5] == (*wanted[doc_id][1:5], wanted[doc_id][7])
