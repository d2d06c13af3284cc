"""Secrets in texts: candidates by form, false positives removed by a random forest.

A candidate is whatever is assigned to a name like token or password, of any length and form,
or a run of at least twelve letters, digits and ``_ + / = -`` with a digit. What tells a key from a number or a name is learnt from labelled findings: the candidate's length
and character transitions, how far words of the corpus cover it, the path it was found
under, and the words beside it.

The statistics behind the features, word counts of the corpus, are of all documents. The
forest (MLlib's) is fitted on a bounded sample of labelled findings.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.llm.durable import durable
from demandloom.llm.sampling import smallest_hashes
from demandloom.llm.words import slices, word_lists

SLICE_BYTES = 8_000_000
MOST_TRAINING = 20_000  # labelled findings the forest is fitted on, those of smallest hash
DICTIONARY = 50_000  # most frequent words of the corpus
TREES, DEPTH = 30, 8
CANDIDATE = re.compile(r"[A-Za-z0-9_+/=\-]{12,}")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\W\d_]+")
# a name, an assignment, and a value in quotes or up to the next space
NAMED = re.compile(
    r"(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth)[\w-]*[\"']?\s*[:=]\s*"
    r"(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"',;]+))", re.I
)
BESIDE = 48  # characters on either side that neighbouring words are taken from
FEATURES = (
    "length", "digits", "upper", "entropy", "changes", "transitions", "coverage", "path", "before", "after",
)


def _spans(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, named) of a text's candidates, in order; none lies in another."""
    found = [(*m.span(m.lastindex), True) for m in NAMED.finditer(text)]
    taken = iter([*found, (len(text) + 1, 0, True)])
    nearest = next(taken)
    others = []
    for m in CANDIDATE.finditer(text):
        while nearest[1] <= m.start() and nearest[0] <= len(text):
            nearest = next(taken)
        if m.end() <= nearest[0] and DIGIT.search(m[0]):
            others.append((*m.span(), False))
    return sorted(found + others)


def find_candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, path, start, candidate, before, after, named) of ``docs(doc_id, text,
    source)``: every candidate with the text beside it. ``start`` counts code points;
    ``named`` tells that it is assigned to a name like token or password."""

    def run(batches):
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32())
        names = ("doc_id", "path", "start", "candidate", "before", "after", "named")
        for batch in batches:
            for first, length in slices(batch.column(1), SLICE_BYTES):
                rows = []
                for doc_id, text, path in zip(*(batch.column(i).slice(first, length).to_pylist() for i in range(3))):
                    for start, end, named in _spans(text or ""):
                        before = text[max(0, start - BESIDE) : start]
                        rows.append((doc_id, path, start, text[start:end], before, text[end : end + BESIDE], int(named)))
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], names)

    return docs.select("doc_id", "text", "source").mapInArrow(
        run, "doc_id long, path string, start long, candidate string, before string, after string, named int"
    )


def frequent_words(docs: DataFrame, most: int = DICTIONARY) -> list[tuple[str, int]]:
    """The corpus's most frequent words of four letters or more, with their counts: all
    that occur at least so often that no more than ``most`` words do, but not only once."""

    def run(batches):
        for batch in batches:
            for start, length in slices(batch.column(0), SLICE_BYTES):
                names, codes, _ = word_lists(batch.column(0).slice(start, length))
                counts = np.bincount(codes, minlength=len(names))
                kept = [i for i, w in enumerate(names) if 4 <= len(w) <= 40 and w.isalpha()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in kept], pa.string()), pa.array(counts[kept].astype(np.int64))], ["word", "n"]
                )

    counted = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = durable(counted.where("n > 1"))
    # one row per number of occurrences; tasks send no words to the driver but those chosen
    words = F.sum("words").over(Window.orderBy(F.col("n").desc()))
    kept = counted.groupBy("n").agg(F.count("*").alias("words")).withColumn("upto", words).where(F.col("upto") <= most)
    least = kept.agg(F.min("n")).first()[0]
    return [] if least is None else [tuple(r) for r in counted.where(F.col("n") >= least).orderBy("word").collect()]


@dataclass
class Evidence:
    """What the features of a candidate are measured against. All tables are of bounded size:
    the dictionary by its parameter, the odds by the training sample."""

    grams: set[str]
    bigrams: dict[str, float]
    path_odds: dict[str, float]
    before_odds: dict[str, float]
    after_odds: dict[str, float]

    @staticmethod
    def of(words: list[tuple[str, int]], rows: list) -> Evidence:
        grams = {w[i : i + 4] for w, _ in words for i in range(len(w) - 3)}
        pairs: Counter[str] = Counter()
        for w, n in words:
            for i in range(len(w) - 1):
                pairs[w[i : i + 2]] += n
        total = sum(pairs.values()) + 1
        bigrams = {p: math.log((n + 0.5) / total) for p, n in pairs.items()}
        base = (sum(r.label for r in rows) + 1) / (len(rows) + 2)
        odds = []
        for texts in (
            lambda r: [r.path or ""], lambda r: _beside(r.before)[-3:], lambda r: _beside(r.after)[:2],
        ):
            seen: dict[str, list[float]] = defaultdict(lambda: [4 * base, 4 * (1 - base)])
            for r in rows:
                for w in set(texts(r)):
                    seen[w][1 - r.label] += 1
            odds.append({w: math.log(a / b) - math.log(base / (1 - base)) for w, (a, b) in seen.items()})
        return Evidence(grams, bigrams, *odds)

    def features(self, path: str | None, candidate: str, before: str, after: str) -> list[float]:
        lower = candidate.lower()
        n = len(candidate)
        kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in candidate]
        shares = [k / n for k in Counter(candidate).values()]
        unseen = -16.0
        fours = [lower[i : i + 4] for i in range(n - 3)]
        covered = np.zeros(n, bool)
        for i, g in enumerate(fours):
            if g in self.grams:
                covered[i : i + 4] = True
        return [
            float(min(n, 512)),
            kinds.count("d") / n,
            kinds.count("u") / n,
            -sum(p * math.log2(p) for p in shares),
            sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
            sum(self.bigrams.get(lower[i : i + 2], unseen) for i in range(n - 1)) / max(1, n - 1),
            float(covered.mean()),
            self.path_odds.get(path or "", 0.0),
            max((self.before_odds.get(w, 0.0) for w in _beside(before)[-3:]), key=abs, default=0.0),
            max((self.after_odds.get(w, 0.0) for w in _beside(after)[:2]), key=abs, default=0.0),
        ]


def _beside(text: str | None) -> list[str]:
    return [w.lower() for w in WORD.findall(text or "")]


def _with_features(findings: DataFrame, evidence: Evidence, hide: bool = False) -> DataFrame:
    """Findings with their feature arrays. ``hide`` blanks the neighbours of every second
    finding, so that a forest cannot rest on them alone."""
    # plain values need no import on executors
    shared = findings.sparkSession.sparkContext.broadcast(vars(evidence))
    kept = [c for c in findings.columns]
    schema = pa.schema([("x", pa.list_(pa.float64()))])

    def run(batches):
        e = Evidence(**shared.value)
        at = {c: i for i, c in enumerate(kept)}
        for batch in batches:
            rows = zip(*(batch.column(at[c]).to_pylist() for c in ("path", "candidate", "before", "after")))
            x = [e.features(*row) for row in rows]
            if hide:
                for features, start in zip(x, batch.column(at["start"]).to_pylist()):
                    if start % 2:
                        features[-2:] = [0.0, 0.0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(x, schema.field("x").type)], [*kept, "x"])

    types = ", ".join(f"{name} {kind}" for name, kind in findings.dtypes)
    return findings.mapInArrow(run, f"{types}, x array<double>")


def scan_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, most: int = MOST_TRAINING
) -> DataFrame:
    """(doc_id, start, length, digest, path, score, is_secret) of every candidate in
    ``docs(doc_id, text, source)``; ``digest`` is the SHA-256 of the candidate.

    ``labelled`` has findings as ``find_candidates`` gives them, with a label 0 or 1. Where
    none are given, those assigned to a name like token or password are taken as secrets
    and the others not; every second one is learnt without its neighbours. Labels of one
    kind only give every candidate that label. Null and empty texts have no candidates; a
    document given twice is returned twice; rows without doc_id or source are scanned too;
    an empty table gives none.
    """
    findings = durable(find_candidates(docs))
    if labelled is None:
        labelled = findings.withColumn("label", F.col("named"))
    # bounded by ``most``
    columns = ["path", "candidate", "before", "after", "start", "label"]
    rows = smallest_hashes(labelled.where("label is not null").select(*columns), columns, most).collect()
    kinds = {r.label for r in rows}
    out = ["doc_id", "start", F.char_length("candidate").alias("length"), F.sha2("candidate", 256).alias("digest"), "path"]
    if len(kinds) < 2:
        only = F.lit(float(next(iter(kinds), 0)))
        return findings.select(*out, only.alias("score"), (only >= threshold).cast("int").alias("is_secret"))
    evidence = Evidence.of(frequent_words(docs), rows)
    sample = docs.sparkSession.createDataFrame(
        rows, "path string, candidate string, before string, after string, start long, label int"
    ).coalesce(1)
    train = durable(_with_features(sample, evidence, hide=True)).select(
        array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label")
    )
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="sqrt").fit(train)
    scored = forest.transform(
        _with_features(findings, evidence).withColumn("features", array_to_vector("x"))
    ).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*out, "score", (F.col("score") >= threshold).cast("int").alias("is_secret"))
