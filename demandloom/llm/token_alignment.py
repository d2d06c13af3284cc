"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers encode a text, and every token ends at a byte offset. Offsets at which tokens
of both end are shared cuts. They are found by divide and conquer: of an interval, the shared
cut nearest its middle is located by bisection, and both halves are treated alike; an interval
without a cut inside is a leaf, the smallest group of tokens that cover the same bytes. All
intervals of a slice of texts take each step together in numpy.

Where two tokens end together one's bytes are a suffix of the other's. So the pairs that can
ever be linked are bounded by the vocabularies alone: a token of n bytes has n suffixes. Their
counts over the corpus are therefore of bounded size (below a million pairs for vocabularies of
some ten thousand tokens), are summed in each task before they are shuffled, and are broadcast
for the second pass, over the stored links: no token is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.durable import stored
from demandloom.llm.tokenizers import ENDS, LETTER, SEAM, TokenizerFile
from demandloom.llm.words import slices

SLICE_BYTES = 1 << 20  # of texts aligned at once
# marks behind a letter, up to the next seam or the end; the character that tells them from parts
# of the same marks behind a space is in no text that is cut
MARKS = re.compile(rf"(?<={LETTER.pattern})[{ENDS}]+(?= \S|\Z)")
MARK = "\x01"
MARKED = f" {MARK}\\g<0>"
TOGETHER = 8192  # words encoded as one text
KNOWN_PARTS = 1 << 18  # parts of texts whose alignment a task remembers

LINK = np.dtype("<u8")  # a's id in the lower half, b's in the upper
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
LOOKED_UP = 1 << 20  # links whose counts a task looks up at once


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray):
    """Places (in a, in b) of tokens that end at the same offset, in order.

    ``ends_a`` and ``ends_b`` are increasing offsets over all texts of a slice; ``docs_a`` and
    ``docs_b`` count the tokens up to each text's end, where both end.
    """
    lo_a, lo_b = np.append(0, docs_a[:-1]), np.append(0, docs_b[:-1])
    hi_a, hi_b = docs_a, docs_b
    cuts_a, cuts_b = [hi_a - 1], [hi_b - 1]
    while len(lo_a):
        # with one token on a side only the interval's end is shared
        open_ = (hi_a - lo_a > 1) & (hi_b - lo_b > 1)
        lo_a, hi_a, lo_b, hi_b = lo_a[open_], hi_a[open_], lo_b[open_], hi_b[open_]
        middle = lo_a + (hi_a - lo_a) // 2 - 1
        cut_a, cut_b = _right(ends_a, ends_b, middle, hi_a - 1)
        none = cut_a == hi_a - 1
        cut_a[none], cut_b[none] = _left(ends_a, ends_b, middle[none] - 1, lo_a[none], lo_b[none])
        found = cut_a >= 0
        cut_a, cut_b = cut_a[found], cut_b[found]
        cuts_a.append(cut_a)
        cuts_b.append(cut_b)
        lo_a, hi_a = np.append(lo_a[found], cut_a + 1), np.append(cut_a + 1, hi_a[found])
        lo_b, hi_b = np.append(lo_b[found], cut_b + 1), np.append(cut_b + 1, hi_b[found])
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def _right(ends_a, ends_b, at, last):
    """The first shared cut at or after a's token ``at``; at the latest the one of ``last``."""
    at, cut_b = at.copy(), np.zeros(len(at), np.int64)
    todo = np.arange(len(at))
    while len(todo):
        b = np.searchsorted(ends_b, ends_a[at[todo]])
        cut_b[todo] = b
        # a's next end that is not before b's
        after = np.searchsorted(ends_a, ends_b[b])
        met = ends_a[after] == ends_b[b]
        at[todo] = after
        todo = todo[~met & (after < last[todo])]
    return at, cut_b


def _left(ends_a, ends_b, at, first_a, first_b):
    """The last shared cut at or before a's token ``at`` within the interval, or -1."""
    cut_a, cut_b = np.full(len(at), -1), np.full(len(at), -1)
    todo = np.flatnonzero(at >= first_a)
    at = at.copy()
    while len(todo):
        b = np.searchsorted(ends_b, ends_a[at[todo]], "right") - 1
        inside = b >= first_b[todo]
        todo, b = todo[inside], b[inside]
        a = np.searchsorted(ends_a, ends_b[b], "right") - 1
        inside = a >= first_a[todo]
        todo, b, a = todo[inside], b[inside], a[inside]
        met = ends_a[a] == ends_b[b]
        cut_a[todo[met]], cut_b[todo[met]] = a[met], b[met]
        at[todo] = a
        todo = todo[~met]
    return cut_a, cut_b


class _Side:
    """One tokenizer in a task, and how long its tokens are."""

    def __init__(self, tokenizer: TokenizerFile):
        self.tokenizer = tokenizer
        self.bytes = tokenizer.token_bytes()
        self.lengths = np.array([len(b) for b in self.bytes])

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text behind a space."""
        # the pieces' model puts the space there itself
        given = text if self.tokenizer.is_pieces else " " + text
        return np.array(self.tokenizer.ids_of(self.tokenizer.encode([given])[0]), np.int64)

    def marks(self, marks: str) -> np.ndarray:
        """Ids of marks right behind a letter."""
        # behind one letter, whose own tokens are left out
        return self.ids("a" + marks)[len(self.ids("a")) :]

    def spell(self, ids: np.ndarray, wanted: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())) == wanted

    def words(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The words that the tokens spell, their ids one behind the other, and how many tokens
        there are up to the end of each. All are encoded as one text, with seams between them;
        where that is not spelled, halves of it."""
        if not words:
            return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = " ".join(words)
        ids = self.ids(text)
        if self.spell(ids, b" " + text.encode()):
            ends = np.cumsum([len(w.encode()) + 1 for w in words])
            return words, ids, np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        half = len(words) // 2
        if not half:
            return self.words([])
        (left, ids, upto), (right, more, after) = self.words(words[:half]), self.words(words[half:])
        return left + right, np.concatenate([ids, more]), np.concatenate([upto, after + len(ids)])


# the groups of a text or part of one, each followed by a semicolon; its links, as bytes; and
# its tokens on both sides
Found = tuple[str, bytes, int, int]


class _Pair:
    """Both tokenizers in a task.

    Texts are taken in parts, between spaces that no token of either crosses: each begins and
    ends at shared cuts. Marks behind words are apart for the same reason. What a part's
    alignment is, is remembered, so most parts are aligned once in a task.
    """

    def __init__(self, a: TokenizerFile, b: TokenizerFile):
        self.sides = (_Side(a), _Side(b))
        self.cut = a.cuts_at_seams and b.cuts_at_seams
        self.marks_apart = self.cut and a.marks_apart and b.marks_apart
        tokens = max(len(side.bytes) for side in self.sides)
        # ids in decimal with what follows them: a's inside and at the end of a group, b's alike
        self.told = [f"{i}{mark}" for i in range(tokens) for mark in (",", "|", ",", ";")]
        self.known: dict[str, Found | None] = {}

    def grouped(self, ids, upto) -> list[Found]:
        """The groups of several parts; ``upto`` counts the tokens up to each part's end."""
        a, b = ids
        ends = [np.cumsum(side.lengths[i]) for side, i in zip(self.sides, ids)]
        cut_a, cut_b = shared_cuts(*ends, *upto)
        links = np.column_stack([a[cut_a], b[cut_b]]).astype("<u4").view(LINK).tobytes()
        # a's tokens come before b's in a group: each moves behind the other side's earlier ones
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a], last_b[cut_b] = 1, 1
        before_b = np.append(0, cut_b + 1)[np.cumsum(last_a) - last_a]
        before_a = (cut_a + 1)[np.cumsum(last_b) - last_b]
        codes = np.zeros(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + before_b] = a * 4 + last_a
        codes[np.arange(len(b)) + before_a] = b * 4 + 2 + last_b
        pieces = list(map(self.told.__getitem__, codes.tolist()))
        links_upto = np.searchsorted(cut_a, upto[0] - 1) + 1
        found, token, link, n_a, n_b = [], 0, 0, 0, 0
        for to_a, to_b, to_link in zip(upto[0].tolist(), upto[1].tolist(), links_upto.tolist()):
            found.append(("".join(pieces[token : to_a + to_b]), links[LINK.itemsize * link : LINK.itemsize * to_link], to_a - n_a, to_b - n_b))
            token, link, n_a, n_b = to_a + to_b, to_link, to_a, to_b
        return found

    def words(self, words: list[str]) -> dict[str, Found]:
        """The alignment of those words that both sides spell."""
        kept, a, upto_a = self.sides[0].words(words)
        spelt, b, upto_b = self.sides[1].words(kept)
        if not spelt:
            return {}
        if len(spelt) < len(kept):
            spelt, a, upto_a = self.sides[0].words(spelt)
        return dict(zip(spelt, self.grouped((a, b), (upto_a, upto_b))))

    def marks(self, marks: str) -> Found | None:
        ids = [side.marks(marks) for side in self.sides]
        if not all(side.spell(i, marks.encode()) for side, i in zip(self.sides, ids)):
            return None
        return self.grouped(ids, [np.array([len(i)]) for i in ids])[0]

    def parts(self, text: str) -> list[str]:
        """The parts of a text; those that are marks behind a word begin with ``MARK``. None of a
        text that is taken whole."""
        if not text or not self.cut or MARK in text:
            return []
        return SEAM.split(MARKS.sub(MARKED, text) if self.marks_apart else text)

    def learn(self, parts: set[str]) -> None:
        """Remember the alignment of these parts."""
        unmet = [p for p in parts if p not in self.known]
        if len(self.known) + len(unmet) > KNOWN_PARTS:
            self.known.clear()
            unmet = list(parts)
        self.known.update((p, self.marks(p[1:])) for p in unmet if p[0] == MARK)
        words = [p for p in unmet if p[0] != MARK]
        # white space at an end of a text would run into the seam
        plain = [w for w in words if w == w.strip()]
        alone = [[w] for w in words if w != w.strip()]
        # the library needs a hundred times the memory of what it encodes at once
        for some in [*(plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)), *alone]:
            found = self.words(some)
            self.known.update((w, found.get(w)) for w in some)

    def aligned(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, links) of each text."""
        parts = [self.parts(t) for t in texts]
        self.learn({p for own in parts for p in own})
        rows = []
        for text, own in zip(texts, parts):
            found = [self.known[p] for p in own] if own or not text else [self.words([text]).get(text)]
            if not found or None in found:
                rows.append((0, 0, 0, 0, "", b""))
                continue
            told, links, n_a, n_b = zip(*found)
            links = b"".join(links)
            groups = len(links) // LINK.itemsize
            digest = hashlib.sha256("".join(told)[:-1].encode()).hexdigest()
            rows.append((sum(n_a), sum(n_b), groups, groups, digest, links))
        return rows


def _aligner(a: TokenizerFile, b: TokenizerFile):
    fields = pa.schema([
        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary()),
    ])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _Pair(a, b)
        for batch in batches:
            texts = batch.column("text")
            for start, length in slices(texts, SLICE_BYTES):
                rows = pair.aligned(pc.fill_null(texts.slice(start, length), "").to_pylist())
                columns = [batch.column("doc_id").slice(start, length).cast(pa.int64())]
                columns += [pa.array([r[k] for r in rows], fields.field(k + 1).type) for k in range(6)]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return align


def aligned(docs: DataFrame, a: TokenizerFile, b: TokenizerFile) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links) of every row.

    ``links`` has two numbers of 32 bits per shared cut, the ids of a's and b's token. Texts that are null, empty or not spelled exactly by
    the tokens of both have none.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_aligner(a, b), ALIGNED)


def _runs(links: pa.Array):
    """(texts, their links as one array, how many each has) of runs of texts that have no more
    than ``LOOKED_UP`` links together, or of a single text."""
    for start, length in slices(links, LOOKED_UP * LINK.itemsize):
        some = links.slice(start, length).to_pylist()
        yield start, np.frombuffer(b"".join(some), LINK), np.array([len(x) // LINK.itemsize for x in some])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) over a task's links: as many rows as there are different pairs."""
    pairs, counts = np.zeros(0, LINK), np.zeros(0, np.int64)
    for batch in batches:
        for _, links, _ in _runs(batch.column(0)):
            new, times = np.unique(links, return_counts=True)
            pairs, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, times]), len(pairs)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(counts)], names=["pair", "n"])


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n): how many links of the corpus hold each pair of ids, b's in the upper half."""
    return links.select("links").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def token_alignment(docs: DataFrame, a: TokenizerFile, b: TokenizerFile) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``count_sum`` adds up over a text's links how many links of the corpus hold their pair;
    ``n_best`` counts those whose pair is the commonest of its b token, ties included. Texts
    that are null, empty or not spelled exactly by the tokens of both have zeros and '';
    a row given twice counts and is returned twice; rows without doc_id are kept; an empty
    table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    links = stored(aligned(docs, a, b), "links")
    # bounded by the vocabularies, see above
    table = pair_counts(links).toArrow()
    pairs = table.column("pair").to_numpy().view(LINK)
    order = np.argsort(pairs)
    pairs, counts = pairs[order], table.column("n").to_numpy()[order]
    # the pairs of a b token lie together
    first = np.flatnonzero(np.append(True, np.diff(pairs >> LINK.type(32)) != 0)) if len(pairs) else order
    best = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(pairs)))) if len(pairs) else counts
    known = spark.sparkContext.broadcast((pairs, counts, counts == best))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, is_best = known.value
        for batch in batches:
            sums = np.zeros((batch.num_rows, 2), np.int64)
            for start, links, lengths in _runs(batch.column("links")):
                place = np.searchsorted(pairs, links)
                ends = np.cumsum(lengths)
                for k, values in enumerate((is_best[place], counts[place])):
                    total = np.append(0, np.cumsum(values, dtype=np.int64))
                    sums[start : start + len(lengths), k] = total[ends] - total[ends - lengths]
            found = {n: batch.column(n) for n in names if n in batch.schema.names}
            found |= {"n_best": pa.array(sums[:, 0]), "count_sum": pa.array(sums[:, 1])}
            yield pa.RecordBatch.from_arrays([found[n] for n in names], names=names)

    kinds = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names)
    return links.mapInArrow(summed, kinds)
