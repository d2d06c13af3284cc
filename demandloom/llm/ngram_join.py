"""Jaccard self-join of documents on word n-grams, by rare-first prefix filtering.

Two texts whose n-gram sets have Jaccard similarity t or more share an n-gram among the
first ``n - ceil(t * n) + 1`` of each, in any order common to all texts (Xiao et al.,
PPJoin+, 2008). The order here is rare first. The steps:

1. Texts of equal sets are one class; only its smallest document goes on.
2. Each class sends its n-grams, packed, to hash buckets. A bucket counts in how many
   classes each occurs. Those of a single class cannot be shared and are only counted;
   the others return with the level of their frequency. A class whose prefix holds only
   n-grams of its own ends here, which most do.
3. Classes that share a prefix n-gram are candidates. They pass a length, a positional
   and a suffix filter, and then the intersection of the sets decides, once per pair.

Candidates are not all pairs: within an n-gram's group each class first meets the
smallest one (hot groups are split, and their parts' smallest meet). Groups that this
leaves in several components are completed: every class outside the group's largest
component meets all classes of other components. A link can only be missed inside a
component, so components are exact, and a group of m copies costs about m checks.
``ngram_links`` lists all links instead.

N-grams are 64-bit hashes; between buckets travel 48 bits beside the bucket's number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.llm.durable import durable, parts_for
from demandloom.llm.groups import components
from demandloom.llm.words import mixed, shingle_sets, slices

# text bytes worked on at once in a task, n-grams to a bucket, classes to a part of a
# hot n-gram's group
SLICE_BYTES = 8_000_000
BUCKET = 4_000_000
HOT_PART = 4096

MAX_UNITS = 10_000  # the similarity is a whole number of these parts
LANES = 4  # parts of the hash space that the suffix filter compares


def shingle_counts(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, s1, s2): the size of each text's n-gram set and two sums over it that
    agree for equal sets only."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for start, length in slices(texts, SLICE_BYTES):
                sets = shingle_sets(texts.slice(start, length), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, length),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(mixed(s).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                        pa.array([int(mixed(~s).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                    ],
                    ["doc_id", "n", "s1", "s2"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long")


def _requests(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """N-grams of each document by bucket: for a run of documents their ids, set sizes and
    how many n-grams each has in the bucket; then the n-grams, 6 bytes each."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, length in slices(texts, SLICE_BYTES):
                sets = shingle_sets(texts.slice(start, length), width)
                sizes = np.array([len(s) for s in sets])
                if not sizes.sum():
                    continue
                grams = np.concatenate(sets)
                owner = np.repeat(np.arange(length, dtype=np.int64), sizes)
                bucket = (grams % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket * length + owner, kind="stable")
                grams, owner, bucket = grams[order] >> np.uint64(16), owner[order], bucket[order]
                runs = np.flatnonzero(np.diff(bucket * length + owner, prepend=-1))
                counts = np.diff(runs, append=len(grams)).astype(np.int32)
                holder = owner[runs]
                firsts = np.flatnonzero(np.diff(bucket, prepend=-1))
                run_firsts = np.searchsorted(runs, firsts)
                low = grams.astype(np.uint32)
                high = (grams >> np.uint64(32)).astype(np.uint16)
                out = {k: [] for k in ("bucket", "docs", "sizes", "counts", "low", "high")}
                for g, ge, r, re in zip(firsts, [*firsts[1:], len(grams)], run_firsts, [*run_firsts[1:], len(runs)]):
                    out["bucket"].append(int(bucket[g]))
                    out["docs"].append(ids[start + holder[r:re]].astype(np.int64).tobytes())
                    out["sizes"].append(sizes[holder[r:re]].astype(np.int32).tobytes())
                    out["counts"].append(counts[r:re].tobytes())
                    out["low"].append(low[g:ge].tobytes())
                    out["high"].append(high[g:ge].tobytes())
                yield pa.RecordBatch.from_pydict(out)

    return docs.mapInArrow(
        run, "bucket long, docs binary, sizes binary, counts binary, low binary, high binary"
    )


def _shared(requests: DataFrame, groups: int) -> DataFrame:
    """Per bucket, n-grams that several classes have, with a level of their frequency;
    sent back by group of documents."""

    def joined(column, kind):
        return np.frombuffer(b"".join(column.to_pylist()), kind)

    def run(key, table):
        bucket = key[0].as_py()
        docs, sizes = joined(table["docs"], np.int64), joined(table["sizes"], np.int32)
        counts = joined(table["counts"], np.int32)
        grams = joined(table["low"], np.uint32).astype(np.uint64)
        grams |= joined(table["high"], np.uint16).astype(np.uint64) << np.uint64(32)
        order = np.argsort(grams, kind="stable")
        firsts = np.flatnonzero(np.diff(grams[order], prepend=np.uint64(2**63)))
        times = np.diff(firsts, append=len(grams))
        df = np.empty(len(grams), np.int64)
        df[order] = np.repeat(times, times)
        held = np.repeat(np.arange(len(docs)), counts)
        kept = np.flatnonzero(df > 1)
        group = (mixed(docs.view(np.uint64)) % np.uint64(groups)).astype(np.int64)[held[kept]]
        kept = kept[np.argsort(group, kind="stable")]
        group = np.sort(group)
        out = {k: [] for k in ("part", "docs", "sizes", "counts", "grams", "levels")}
        edges = [*np.flatnonzero(np.diff(group, prepend=-1)), len(group)]
        full = (grams << np.uint64(16)) | np.uint64(bucket & 0xFFFF)
        level = np.minimum(255, np.log2(np.maximum(df, 1)) * 4).astype(np.uint8)
        for a, b in zip(edges[:-1], edges[1:]):
            own = kept[a:b]
            runs = np.flatnonzero(np.diff(held[own], prepend=-1))
            out["part"].append(int(group[a]))
            out["docs"].append(docs[held[own][runs]].tobytes())
            out["sizes"].append(sizes[held[own][runs]].tobytes())
            out["counts"].append(np.diff(runs, append=len(own)).astype(np.int32).tobytes())
            out["grams"].append(full[own].tobytes())
            out["levels"].append(level[own].tobytes())
        return pa.table(
            out,
            schema=pa.schema(
                [("part", pa.int64())]
                + [(k, pa.binary()) for k in ("docs", "sizes", "counts", "grams", "levels")]
            ),
        )

    return requests.groupBy("bucket").applyInArrow(
        run, "part long, docs binary, sizes binary, counts binary, grams binary, levels binary"
    )


def _seen_before(grams: np.ndarray) -> list[list[int]]:
    """For each n-gram, the n-grams before it as marks in 2 * 64 bits."""
    at = ((grams >> np.uint64(49)) & np.uint64(127)).astype(np.int64)
    marks = np.zeros((len(grams), 2), np.uint64)
    marks[np.arange(len(grams)), at >> 6] = np.uint64(1) << (at & 63).astype(np.uint64)
    upto = np.bitwise_or.accumulate(marks, axis=0)
    before = np.concatenate((np.zeros((1, 2), np.uint64), upto[:-1]))
    return before.view(np.int64).tolist()


def _prefixes(shared: DataFrame, units: int) -> DataFrame:
    """Per class with a shared n-gram in its prefix: the set size, the shared n-grams in
    hash order and their counts by part of the hash space, those of the prefix in
    rare-first order with their levels, and marks of the n-grams before each of these."""

    def joined(column, kind):
        return np.frombuffer(b"".join(column.to_pylist()), kind)

    def run(key, table):
        docs, sizes = joined(table["docs"], np.int64), joined(table["sizes"], np.int32)
        counts = joined(table["counts"], np.int32)
        grams, levels = joined(table["grams"], np.uint64), joined(table["levels"], np.uint8)
        owner = np.repeat(docs, counts)
        order = np.lexsort((grams, levels, owner))
        grams, levels, owner = grams[order], levels[order], owner[order]
        once = np.ones(len(owner), bool)  # a row given twice sends its n-grams twice
        once[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
        grams, levels, owner = grams[once], levels[once], owner[once]
        firsts = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1 if len(owner) else 0))
        size_of = dict(zip(docs.tolist(), sizes.tolist()))
        out = {k: [] for k in ("doc_id", "n", "shared", "lanes", "grams", "prefix", "levels", "seen")}
        for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(owner)]):
            n = size_of[int(owner[a])]
            alone = n - (b - a)
            prefix = n - -(-units * n // MAX_UNITS) + 1
            if alone >= prefix:
                continue
            lanes = np.minimum(65535, np.bincount((grams[a:b] >> np.uint64(62)).astype(int), minlength=LANES))
            head = slice(a, a + prefix - alone)
            out["doc_id"].append(int(owner[a]))
            out["n"].append(n)
            out["shared"].append(b - a)
            out["lanes"].append(lanes.tolist())
            out["grams"].append(np.sort(grams[a:b]).tobytes())
            out["prefix"].append(grams[head].view(np.int64))
            out["levels"].append(levels[head].astype(np.int16))
            out["seen"].append(_seen_before(grams[head]))
        return pa.table(
            out,
            schema=pa.schema(
                [
                    ("doc_id", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()),
                    ("lanes", pa.list_(pa.int32())), ("grams", pa.binary()),
                    ("prefix", pa.list_(pa.int64())), ("levels", pa.list_(pa.int16())),
                    ("seen", pa.list_(pa.list_(pa.int64()))),
                ]
            ),
        )

    return shared.groupBy("part").applyInArrow(
        run,
        "doc_id long, n long, shared long, lanes array<int>, grams binary, "
        "prefix array<long>, levels array<short>, seen array<array<long>>",
    )


def _once(pairs: DataFrame, units: int) -> DataFrame:
    """Pairs of (x, y) once each, with the overlap they need."""
    x, y = F.col("x.meta"), F.col("y.meta")
    return (
        pairs.groupBy(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        .agg(F.first(x.n).alias("n_a"), F.first(y.n).alias("n_b"), F.first(_need(x, y, units)).alias("need"))
    )


def _need(x: Column, y: Column, units: int) -> Column:
    """The overlap that two sets of these sizes need."""
    return F.ceil((x.n + y.n) * units / F.lit(MAX_UNITS + units))


def _may_link(units: int) -> Column:
    """Length, positional and suffix filter of x and y, which share a prefix n-gram.

    Their sizes must be near. The overlap is at most what they share before the n-gram,
    itself, and the shorter rest behind it; each mark of x that y lacks is an n-gram of x
    before the shared one that is not in y's prefix there. Parts of the hash space whose
    counts differ hold n-grams that the other text has not.
    """
    x, y = F.col("x.meta"), F.col("y.meta")
    need = _need(x, y, units)

    def common_before(p: Column, q: Column) -> Column:
        alone = sum(F.bit_count(p.seen[k].bitwiseAND(F.bitwise_not(q.seen[k]))) for k in range(2))
        return p["at"] - alone

    p, q = F.col("x"), F.col("y")
    behind = F.least(x.shared - p["at"], y.shared - q["at"])
    differing = sum(F.abs(x.lanes[k] - y.lanes[k]) for k in range(LANES))
    return (
        (F.least(x.n, y.n) * MAX_UNITS >= F.greatest(x.n, y.n) * units)
        & (F.least(common_before(p, q), common_before(q, p)) + behind >= need)
        & (differing <= x.shared + y.shared - 2 * need)
    )


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs, those whose sets overlap enough, with the overlap."""

    @F.pandas_udf("long")
    def overlap(x, y):
        return x.combine(
            y,
            lambda p, q: len(
                np.intersect1d(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), assume_unique=True)
            ),
        ).astype("int64")

    left = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("p"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("q"))
    return (
        pairs.join(left, "a").join(right, "b")
        .withColumn("overlap", overlap("p", "q"))
        .where("overlap >= need")
        .select("a", "b", "n_a", "n_b", "overlap")
    )


class _Candidates:
    """Classes that may have links, and their prefix n-grams."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int, units: int):
        spark = docs.sparkSession
        total = classes.agg(F.sum("n")).first()[0] or 0
        buckets = parts_for(spark, total, BUCKET)
        first = docs.join(classes.select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
        shared = _shared(_requests(first.select("doc_id", "text"), width, buckets), buckets)
        self.sets = durable(_prefixes(shared, units))
        self.units = units
        # in the condition of each join, so that only pairs that may link leave it
        self._room = _may_link(units)
        meta = F.struct("n", "shared", "lanes").alias("meta")
        self.tokens = self.sets.select(
            "doc_id", meta, F.posexplode("prefix").alias("at", "gram"), "levels", "seen"
        ).select(
            "gram",
            F.col("levels")[F.col("at")].alias("level"),
            F.struct("doc_id", "meta", "at", F.col("seen")[F.col("at")].alias("seen")).alias("x"),
        )

    def every_pair(self) -> DataFrame:
        tokens = self.tokens.select("gram", "x")
        other = tokens.select("gram", F.col("x").alias("y"))
        return tokens.join(other, "gram").where("x.doc_id < y.doc_id").where(self._room)

    def star_pairs(self) -> DataFrame:
        """Each class with the smallest of its n-gram's group, or of its part of a hot
        group; and the smallest of the parts with the smallest of the group."""
        times = F.pow(F.lit(2.0), F.col("level") / 4)
        part = F.pmod(F.xxhash64("x.doc_id"), F.greatest(F.lit(1), F.ceil(times / HOT_PART))).alias("part")
        within = Window.partitionBy("gram", "part").orderBy("x.doc_id")
        met = self.tokens.select("gram", "level", "x", part).withColumn(
            "y", F.first("x").over(within.rowsBetween(Window.unboundedPreceding, 0))
        )
        stars = met.where("x.doc_id <> y.doc_id").select(F.col("y").alias("x"), F.col("x").alias("y"))
        heads = met.where("x.doc_id = y.doc_id").where(times > HOT_PART)
        across = Window.partitionBy("gram").orderBy("x.doc_id")
        tops = heads.withColumn("y", F.first("x").over(across.rowsBetween(Window.unboundedPreceding, 0)))
        tops = tops.where("x.doc_id <> y.doc_id").select(F.col("y").alias("x"), F.col("x").alias("y"))
        return stars.unionByName(tops).where(self._room)

    def open_pairs(self, labels: DataFrame) -> DataFrame:
        """Pairs within an n-gram's group whose classes are in different components: those
        outside the group's largest component with all others."""
        named = self.tokens.join(
            labels.select(F.col("node").alias("doc"), "component"), F.col("x.doc_id") == F.col("doc"), "left"
        ).select("gram", "x", F.coalesce("component", "x.doc_id").alias("c"))
        sizes = named.groupBy("gram", "c").agg(F.count("*").alias("m"))
        mixed_groups = (
            sizes.groupBy("gram")
            .agg(F.max_by("c", F.struct("m", "c")).alias("main"), F.count("*").alias("parts"))
            .where("parts > 1")
        )
        members = named.join(mixed_groups, "gram")
        outside = members.where("c <> main").select("gram", "x", "c")
        others = members.select("gram", F.col("x").alias("y"), F.col("c").alias("d"), "main")
        return (
            outside.join(others, "gram")
            .where("c <> d and (d = main or x.doc_id < y.doc_id)")
            .where(self._room)
            .select(
                F.when(F.col("x.doc_id") < F.col("y.doc_id"), F.col("x")).otherwise(F.col("y")).alias("x"),
                F.when(F.col("x.doc_id") < F.col("y.doc_id"), F.col("y")).otherwise(F.col("x")).alias("y"),
            )
        )

    def links(self, pairs: DataFrame) -> DataFrame:
        return _linked(_once(pairs, self.units), self.sets)


def _prepared(docs: DataFrame, width: int, similarity: float):
    units = round(similarity * MAX_UNITS)
    if not 0 < units <= MAX_UNITS or width < 1:
        raise ValueError("similarity must be over 0 and at most 1, width 1 or more")
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    counts = durable(shingle_counts(docs, width))
    classes = counts.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("doc_id"))
    return docs, counts, durable(classes), units


def ngram_links(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """All links between different n-gram sets, and who belongs to which class.

    Returns links (a, b, n_a, n_b, overlap) between class representatives, a < b, and
    membership (doc_id, n_shingles, class_id), null class for texts without words. Texts
    of equal sets are linked by being one class. The number of links, and so the work,
    grows with the square of the largest group of different near copies.
    """
    docs, counts, classes, units = _prepared(docs, width, similarity)
    found = _Candidates(docs, classes, width, units)
    classes = classes.withColumnRenamed("doc_id", "class_id")
    member = counts.join(classes, ["n", "s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "class_id"
    )
    return found.links(found.every_pair()), member


def ngram_components(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs(doc_id, text)``.

    A text's set is its distinct ``width``-word shingles, A-Z lower-cased; a shorter text
    is one shingle; a null or blank text has none and is alone. Texts link when overlap
    >= similarity * union, and a component is named by its smallest doc_id. A doc_id
    stands for one text: a row given twice is returned twice, in one component. Rows
    without doc_id take no part; an empty table gives none; other columns are not read.
    """
    docs, counts, classes, units = _prepared(docs, width, similarity)
    found = _Candidates(docs, classes, width, units)
    stars = durable(found.links(found.star_pairs()).select("a", "b"))
    labels = components(stars)
    more = durable(found.links(found.open_pairs(labels)).select("a", "b"))
    if not more.isEmpty():
        labels = components(stars.unionByName(more))
    named = classes.join(
        labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left"
    ).select("n", "s1", "s2", F.coalesce("component", "doc_id").alias("component"))
    return counts.join(named, ["n", "s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with the document of smallest doc_id of each component; all columns kept.

    Documents without words, and rows without doc_id, are in no component and stay. A row
    given twice stays once.
    """
    found = durable(ngram_components(docs, width, similarity))
    copies = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    named = kept.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(kept.where("doc_id is null"))
