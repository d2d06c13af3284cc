"""Phrase collocations by SON partitioning (Savasere, Omiecinski and Navathe, 1995).

The corpus is cut into a few shards. A phrase that the corpus holds ``support`` times is held
at least ``support / shards`` times by one shard, so every shard is mined completely at that
lowered support, and what is frequent in some shard is a candidate. A second pass counts all
candidates over the whole corpus, by their words, and keeps those with the full support.

A shard is any number of input partitions. Tasks count the phrases of slices of text exactly,
merge the counts of their slices, and send them on by hash in buckets, whose number grows with
the text; where a bucket's counts meet they are summed per shard. Hashes only choose
candidates: two phrases with one hash could make more candidates, never fewer. The second pass
knows the candidates by a bitmap of fixed size, of which each bucket has a part; a phrase that
passes it by chance is counted like the others and falls by its count. So the broadcast does
not grow with the corpus, and counts are those of the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.llm.durable import parts_for, stored
from demandloom.llm.words import STEP, mixed, slices

SHARDS = 2
SLICE_BYTES = 1 << 20  # of text counted at once
MERGED = 1 << 20  # counts of slices that a task merges before they leave it
BUCKET_BYTES = 8 << 20  # of text for each bucket
MOST = 255  # counts in a shard are told apart up to here
UNKNOWN = "und"
BITS = 27  # the bitmap of candidates has 2 ** BITS bits
SALT = 16  # parts in which the first phrases of a language are looked for

# What separates pieces and words
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + PIECE_ENDS, bytes(range(97, 123)) + b" " + b"\n" * len(PIECE_ENDS)
)


class _Slice:
    """The words of some texts in order, and the different phrases among them."""

    def __init__(self, texts: list[bytes]):
        # each end of a piece, and of a text, becomes a token of its own
        flat = b"\n".join(texts).translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        codes, names = pd.factorize(np.array(flat, dtype=object))
        dropped = np.isin(names, [b""])
        if dropped.any():
            codes = codes[~dropped[codes]]
        self.names = names
        self.is_word = names != b"\n"
        self.codes = codes.astype(np.int64)

    def phrases(self, longest: int):
        """Per number of words: (words of each different phrase as columns, its count)."""
        vocabulary = len(self.names)
        whole = self.is_word[self.codes] if vocabulary else np.zeros(0, bool)
        place = np.flatnonzero(whole)
        phrase, distinct = pd.factorize(self.codes[place])
        columns = distinct[:, None]
        yield columns, np.bincount(phrase, minlength=len(distinct))
        for n in range(2, longest + 1):
            # the phrase of n - 1 words here and the word behind it: exact, without hashes
            inside = np.flatnonzero(place + n - 1 < len(self.codes))
            inside = inside[whole[place[inside] + n - 1]]
            place, phrase = place[inside], phrase[inside]
            phrase, distinct = pd.factorize(phrase * vocabulary + self.codes[place + n - 1])
            columns = np.column_stack([columns[distinct // vocabulary], distinct % vocabulary])
            yield columns, np.bincount(phrase, minlength=len(distinct))

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.names), np.uint64, len(self.names))


def _keys(lang: str, hashes: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """A hash of each phrase in its language."""
    key = np.full(len(columns), xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
    for k in range(columns.shape[1]):
        key = mixed(key * STEP + hashes[columns[:, k]])
    return key


def _slices(batches: Iterator[pa.RecordBatch]):
    """(lang, slice) over a task's rows (lang, text)."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for lang in dict.fromkeys(langs):
            own = texts.take(pa.array([i for i, x in enumerate(langs) if x == lang]))
            for start, length in slices(own, SLICE_BYTES):
                yield lang, _Slice(own.slice(start, length).to_pylist())


def _bucketed(key: np.ndarray, buckets: int):
    """The bucket of each key, and 32 bits that tell keys of a bucket apart."""
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), key.astype(np.uint32)


def _summed(keys: np.ndarray, counts: np.ndarray):
    """Distinct keys in order, and the sums of their counts, up to MOST."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(counts, first) if len(keys) else counts
    return keys[first], np.minimum(sums, MOST).astype(np.uint8)


def _shard_counter(shards: int, longest: int, buckets: int):
    def sent(shard: int, held: list) -> pa.RecordBatch:
        keys, counts = _summed(*(np.concatenate(x) for x in zip(*held)))
        bucket, low = _bucketed(keys, buckets)
        # keys in order lie in order of buckets
        ends = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) + 1
        starts = np.append(0, ends[:-1])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[starts]), pa.array(np.full(len(starts), shard, np.int32)),
                pa.array([low[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()),
                pa.array([counts[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()),
            ],
            names=["bucket", "shard", "keys", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        held, size = [], 0
        for lang, part in _slices(batches):
            hashes = part.hashes()
            for columns, counts in part.phrases(longest):
                if len(columns):
                    held.append((_keys(lang, hashes, columns), np.minimum(counts, MOST).astype(np.uint8)))
                    size += len(columns)
            if size >= MERGED:
                yield sent(shard, held)
                held, size = [], 0
        if held:
            yield sent(shard, held)

    return count


def _places(low: np.ndarray, size: int):
    """Two bits of a bucket's part of the bitmap, of ``size`` bits, for each key."""
    for odd in (0x9E3779B1, 0x85EBCA77):
        yield (low * np.uint32(odd)).astype(np.uint64) * np.uint64(size) >> np.uint64(32)


def _miner(local: int, size: int):
    def mine(key: tuple, parts: pa.Table) -> pa.Table:
        bits = np.zeros(size, bool)
        shards = parts.column("shard").to_numpy()
        for shard in np.unique(shards):
            own = parts.filter(pa.array(shards == shard))
            keys, counts = _summed(
                np.concatenate([np.frombuffer(x, np.uint32) for x in own.column("keys").to_pylist()]),
                np.concatenate([np.frombuffer(x, np.uint8) for x in own.column("counts").to_pylist()]),
            )
            for place in _places(keys[counts >= local], size):
                bits[place] = True
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return mine


class _Candidates:
    """The bitmap: which phrases some shard may hold often enough."""

    def __init__(self, buckets: int, found: pa.Table):
        self.buckets, self.size = buckets, part_bits(buckets)
        self.bits = np.zeros((buckets, self.size // 8), np.uint8)
        for bucket, bits in zip(found.column("bucket").to_pylist(), found.column("bits").to_pylist()):
            self.bits[bucket] = np.frombuffer(bits, np.uint8)

    def hold(self, key: np.ndarray) -> np.ndarray:
        bucket, low = _bucketed(key, self.buckets)
        kept = np.ones(len(key), bool)
        for place in _places(low, self.size):
            kept &= (self.bits[bucket, place >> np.uint64(3)] >> (7 - (place & np.uint64(7))).astype(np.uint8)) & 1 > 0
        return kept


def part_bits(buckets: int) -> int:
    """Bits of the bitmap for each bucket; all of them together do not grow."""
    return max(8, (1 << BITS) // buckets // 8 * 8)


def candidates(texts: DataFrame, longest: int, support: int, shards: int) -> _Candidates:
    """What is frequent in a shard of (lang, text) rows, at the support lowered in proportion."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    buckets = parts_for(texts.sparkSession, size, BUCKET_BYTES)
    counted = texts.mapInArrow(_shard_counter(shards, longest, buckets), "bucket long, shard int, keys binary, counts binary")
    mine = _miner(-(-support // shards), part_bits(buckets))
    return _Candidates(buckets, counted.groupBy("bucket").applyInArrow(mine, "bucket long, bits binary").toArrow())


def _phrase_counter(found, longest: int):
    fields = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, part in _slices(batches):
            hashes = part.hashes()
            names = pa.array(part.names, pa.binary()).cast(pa.string())
            for columns, counts in part.phrases(longest):
                n = columns.shape[1]
                if n == 1:  # all words of the language, under no phrase
                    yield _rows(fields, lang, pa.array([""]), 0, np.array([counts.sum()]))
                # no phrase is more frequent than what it holds
                for length in range(1, n + 1):
                    for start in range(n - length + 1):
                        kept = found.value.hold(_keys(lang, hashes, columns[:, start : start + length]))
                        columns, counts = columns[kept], counts[kept]
                if len(columns):
                    words = [names.take(pa.array(columns[:, k])) for k in range(n)]
                    yield _rows(fields, lang, pc.binary_join_element_wise(*words, " "), n, counts)

    return count


def _rows(fields: pa.Schema, lang: str, phrases: pa.Array, words: int, counts: np.ndarray) -> pa.RecordBatch:
    n = len(phrases)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), phrases, pa.array(np.full(n, words, np.int32)), pa.array(counts, pa.int64())],
        schema=fields,
    )


def frequent_phrases(docs: DataFrame, longest: int, support: int, shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, words, n) of every phrase of up to ``longest`` words that its language
    holds ``support`` times or more; the phrase '' of 0 words has the number of all words.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs;
    phrases lie within pieces, and overlapping occurrences count. Null texts are empty, a null
    language is ``und``; a row given twice counts twice; an empty table has no phrases.
    """
    if not 1 <= shards <= support <= MOST * shards:
        raise ValueError(f"shards must be between 1 and the support, the support at most {MOST} times that")
    texts = docs.select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    found = docs.sparkSession.sparkContext.broadcast(candidates(texts, longest, support, shards))
    return (
        texts.mapInArrow(_phrase_counter(found, longest), "lang string, phrase string, words int, n long")
        .groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
        .where((F.col("n") >= support) | (F.col("words") == 0))
    )


def _part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, longest: int = 3, support: int = 10, shards: int = SHARDS, most: int = 2000, absorbed: int = 50
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of each language.

    A phrase of two words or more with ``a`` occurrences, cut into parts with l and r
    occurrences, scores floor(1000000 a a / (l r)); its worst cut counts, of equals the first.
    Phrases that lie in a longer one with at least ``absorbed`` percent of their occurrences
    are left out. Best scores come first, then more occurrences, then the phrase itself; ``n``
    is the number of words of the language. Rows are treated as by ``frequent_phrases``.
    """
    counts = stored(frequent_phrases(docs, longest, support, shards), "phrases")
    words = F.split("phrase", " ")
    phrases = counts.where("words >= 2").select("lang", "phrase", F.col("n").alias("a"), "words", words.alias("w"))
    cuts = phrases.select(
        "lang", "phrase", "a", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", _part(F.col("w"), 1, F.col("k")).alias("first"),
        _part(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )
    part = counts.where("words > 0")
    scored = (
        cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
        .join(part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
        # products of counts pass 64 bits; 38 digits hold a million times the square of 10^15
        .withColumn("score", F.expr("""cast(
            cast(1000000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(a as decimal(38,0))
            div (cast(l as decimal(38,0)) * cast(r as decimal(38,0))) as long)"""))
        .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    # every shorter phrase inside a phrase, with the occurrences of the longest holder
    inner = phrases.where("words > 2").select(
        "lang", "a", "words", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("length")
    ).select(
        "lang", "a", "w", "length", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)).alias("start")
    ).select("lang", "a", _part(F.col("w"), F.col("start"), F.col("length")).alias("phrase"))
    held = inner.groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    best = (
        scored.join(held, ["lang", "phrase"], "left")
        .where(F.coalesce(100 * F.col("held") < absorbed * F.col("a"), F.lit(True))).drop("held")
    )
    # the first of each part of a language, then of these the language's first
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*order)
    few = best.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= most)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    totals = counts.where("words = 0").select("lang", "n")
    return ranked.where(F.col("rank") <= most).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
