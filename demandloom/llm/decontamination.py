"""Benchmark decontamination by pigeonhole pieces and Myers' bit-parallel distance.

A test item may be edited in up to ``k`` places. Cut into k + 1 pieces, at least one piece
is found unchanged (pigeonhole). One automaton finds the pieces of all items in a text. A
hit is then checked from the piece outwards, through ever larger halves of the item: some
path from a piece up exists on which every part of s pieces has fewer than s edits (Navarro
and Baeza-Yates, 1999), so a chance hit ends at its neighbour. Distances are Myers'
(1999), with Python's integers as bit vectors of any length.

Items travel to the tasks in groups of bounded size, one pass over the documents each.
"""

from __future__ import annotations

import math

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 0.1  # edits allowed per character of an item
MIN_CHARS = 20  # of a normalised item; shorter ones occur by chance
GROUP_CHARS = 20_000_000


def normalised(text: str) -> str:
    """Lower case, and one space for any white space."""
    return " ".join(text.lower().split())


def best_end(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """The least edit distance of a pattern to any part of ``text``, and the first place
    where a part with it ends. ``masks`` has the pattern's places of each character."""
    full = (1 << length) - 1
    top = 1 << (length - 1)
    positive, negative, score = full, 0, length
    best, end = length, 0
    for at, character in enumerate(text):
        equal = masks.get(character, 0)
        vertical = equal | negative
        horizontal = (((equal & positive) + positive) ^ positive) | equal
        up = negative | (full & ~(horizontal | positive))
        down = positive & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, at + 1
        up, down = (up << 1) & full, (down << 1) & full
        positive = down | (full & ~(vertical | up))
        negative = up & vertical
    return best, end


class _Item:
    """An item's pieces, and the parts of it that contain each piece."""

    def __init__(self, item_id: int, text: str, budget: int):
        self.item_id, self.text, self.budget = item_id, text, budget
        self.cuts = [round(len(text) * i / (budget + 1)) for i in range(budget + 2)]
        self._parts: dict[int, list[tuple[int, int]]] = {}
        self._masks: dict[tuple[int, int], dict[str, int]] = {}

    def pieces(self):
        return [(i, self.text[a:b]) for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:]))]

    def parts(self, piece: int) -> list[tuple[int, int]]:
        """Ranges of pieces around one, smallest first, without the piece and the whole."""
        if piece not in self._parts:
            low, high, found = 0, self.budget + 1, []
            while high - low > 1:
                found.append((low, high))
                middle = (low + high) // 2
                low, high = (low, middle) if piece < middle else (middle, high)
            self._parts[piece] = found[:0:-1]
        return self._parts[piece]

    def masks(self, low: int, high: int) -> dict[str, int]:
        if (low, high) not in self._masks:
            masks: dict[str, int] = {}
            for i, c in enumerate(self.text[self.cuts[low] : self.cuts[high]]):
                masks[c] = masks.get(c, 0) | 1 << i
            self._masks[low, high] = masks
        return self._masks[low, high]

    def within(self, low: int, high: int, text: str, start: int, slack: int) -> tuple[int, int]:
        """Distance of a part to the text around where it would start, and its end."""
        length = self.cuts[high] - self.cuts[low]
        begin = max(0, start - slack)
        best, end = best_end(self.masks(low, high), length, text[begin : max(0, start + length + slack)])
        return best, begin + end


def _automaton(items: list[tuple[int, str, int]]):
    found = ahocorasick.Automaton()
    holders: dict[str, list[tuple[_Item, int]]] = {}
    for item_id, text, budget in items:
        item = _Item(item_id, text, budget)
        for at, piece in item.pieces():
            holders.setdefault(piece, []).append((item, at))
    for piece, of in holders.items():
        found.add_word(piece, of)
    found.make_automaton()
    return found


def _matches(automaton, text: str) -> dict[int, tuple[int, int]]:
    """Distance and end of the best place of each item that the text has."""
    best: dict[int, tuple[int, int]] = {}
    done: dict[int, list[int]] = {}
    for last, holders in automaton.iter(text):
        for item, at in holders:
            start = last + 1 - item.cuts[at + 1]
            seen = done.setdefault(item.item_id, [])
            if any(abs(start - s) <= item.budget for s in seen):
                continue
            if any(
                item.within(low, high, text, start + item.cuts[low], high - low - 1)[0] >= high - low
                for low, high in item.parts(at)
            ):
                continue
            # twice the budget, so that the places around a known one need no second look
            distance, end = item.within(0, item.budget + 1, text, start, 2 * item.budget)
            if distance <= item.budget:
                seen.append(start)
                best[item.item_id] = min(best.get(item.item_id, (distance, end)), (distance, end))
    return best


def contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS
) -> DataFrame:
    """(doc_id, item_id, distance, item_chars, end) for every document that holds an item
    of ``benchmark(item_id, text)`` with at most ``rate`` edits per character.

    ``distance`` is the least over the whole normalised text, ``end`` the first place where
    a part with it ends. Null and empty texts hold nothing; items that are null or shorter
    than ``min_chars`` are not looked for; an item given twice counts once, and of items
    that share an id each text is looked for and the best counts. A document given twice
    is returned twice. Empty tables give no rows.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(chars / GROUP_CHARS))
    found = None
    for g in range(groups):
        # about GROUP_CHARS characters, the bound on what travels with a pass
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).orderBy("item_id", "text").collect()
        texts = [(r.item_id, normalised(r.text)) for r in rows]
        part = [(i, t, int(rate * len(t))) for i, t in texts if len(t) >= max(min_chars, 1)]
        if part:
            block = _search(docs, spark.sparkContext.broadcast(part))
            found = block if found is None else found.unionByName(block)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, distance int, item_chars int, end long")
    return found


def _search(docs: DataFrame, items) -> DataFrame:
    def run(batches):
        automaton = _automaton(items.value)
        lengths = {i: len(t) for i, t, _ in items.value}
        for batch in batches:
            out = {k: [] for k in ("doc_id", "item_id", "distance", "item_chars", "end")}
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                for item, (distance, end) in _matches(automaton, normalised(text)).items() if text else ():
                    out["doc_id"].append(doc_id.as_py())
                    out["item_id"].append(item)
                    out["distance"].append(distance)
                    out["item_chars"].append(lengths[item])
                    out["end"].append(end)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["doc_id"], pa.int64()), pa.array(out["item_id"], pa.int64()),
                    pa.array(out["distance"], pa.int32()), pa.array(out["item_chars"], pa.int32()),
                    pa.array(out["end"], pa.int64()),
                ],
                list(out),
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, item_id long, distance int, item_chars int, end long"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` without the documents that hold a test item; rows without doc_id stay.

    Null and empty texts hold none and stay; rows given twice stay or go together; without items
    all rows stay; an empty table gives none; all columns are kept."""
    hit = contaminated(docs.where("doc_id is not null"), benchmark, rate).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*docs.columns)
