"""Point-in-range lookup: attach to each point the value of the range it falls in.

Ranges are half-open ``[start, end)`` and live inside a key, such as a country. A
plain join on the key would test every range of the country for every point, so
ranges are cut into blocks of ``2**shift`` codes and joined on (key, block).

The ranges are measured first. Small ones are broadcast and the points never move.
Larger ones are matched against the *distinct* points only, and the resulting
point -> value map is joined back. Codes that hold more than a thousandth of the
points are found by counting and split in proportion, so that no code, however hot,
is one task's work; there are at most a thousand of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# a code with more than 1/PIECES of the points is split into pieces of that size
PIECES = 1_000
# a block holds at most 2**BLOCK_BITS codes, unless a range would touch more than
# 2**SPAN_BITS blocks
BLOCK_BITS = 20
SPAN_BITS = 12


@dataclass(frozen=True)
class RangeColumns:
    keys: tuple[str, ...] = ("country",)
    point: str = "zipcode"
    start: str = "s_zipcode"
    end: str = "e_zipcode"
    value: str = "city"


ZIP_RANGES = RangeColumns()


@dataclass(frozen=True)
class RangeLookup:
    """Ranges together with their measured size, ready to be matched."""

    ranges: DataFrame
    columns: RangeColumns
    rows: int
    bytes: int
    shift: int
    classes: tuple[int, ...]
    broadcast_rows: int
    broadcast_bytes: int
    pieces: int

    @property
    def broadcasts(self) -> bool:
        return self.rows <= self.broadcast_rows and self.bytes <= self.broadcast_bytes


def measure_ranges(
    ranges: DataFrame,
    columns: RangeColumns = ZIP_RANGES,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    pieces: int = PIECES,
) -> RangeLookup:
    """Measure the range table with one distributed aggregate.

    The block size is the mean range width rounded up to a power of two, which keeps
    the cut ranges below three per range; the size check counts them all.
    """
    c = columns
    ranges = ranges.select(*c.keys, c.start, c.end, c.value).filter(
        F.col(c.end) > F.col(c.start)
    )
    text = sum(
        (F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in (*c.keys, c.value)),
        F.lit(32),
    )
    size = ranges.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(text), F.lit(0)).alias("bytes"),
        F.coalesce(F.avg(F.col(c.end).cast("double") - F.col(c.start).cast("double")), F.lit(1.0)).alias("width"),
        # at most 17 values
        F.sort_array(F.collect_set(_class(c))).alias("classes"),
    ).first()
    return RangeLookup(
        ranges=ranges,
        columns=c,
        rows=3 * size["rows"],
        bytes=3 * size["bytes"],
        shift=max(0, math.ceil(math.log2(max(1.0, size["width"])))),
        classes=tuple(size["classes"]),
        broadcast_rows=broadcast_rows,
        broadcast_bytes=broadcast_bytes,
        pieces=pieces,
    )


def match_ranges(
    points: DataFrame,
    lookup: RangeLookup,
    how: str = "inner",
    unique_by: list[str] | None = None,
) -> DataFrame:
    """Points with the matching range's value.

    ``inner`` drops points outside every range and repeats a point that lies in
    several; ``left`` keeps unmatched points with a null value. ``unique_by`` names
    columns that tell apart the points of one code; without it, copies are expected.
    """
    if lookup.broadcasts:
        return _match_by_broadcast(points, lookup, how)
    return _match_by_map(points, lookup, how, unique_by)


def first_match_ranges(
    ranges: DataFrame, columns: RangeColumns = ZIP_RANGES, chunk_bits: int = 16
) -> DataFrame:
    """Ranges clipped so that they no longer overlap and the first one wins.

    In order of start, every earlier range that reaches past this start covers it
    from there up to the furthest earlier end, so what is left of a range begins at
    that end. The work is on the range table; the points need no de-duplication. The
    running maximum is taken over chunks of ``2**chunk_bits`` codes first, then inside
    each chunk, so that a key with most of the ranges is not one task's work.
    """
    c = columns
    chunk = [*c.keys, "_chunk"]
    usable = ranges.filter(F.col(c.end) > F.col(c.start)).withColumn(
        "_chunk", _block(c.start, chunk_bits)
    )
    before = Window.partitionBy(*c.keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    reached = (
        usable.groupBy(*chunk)
        .agg(F.max(c.end).alias("_end"))
        .select(*chunk, F.max("_end").over(before).alias("_reached"))
    )
    earlier = (
        Window.partitionBy(*chunk)
        .orderBy(c.start, c.value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    covered = F.greatest(F.col(c.start), F.col("_reached"), F.max(c.end).over(earlier))
    return (
        usable.join(reached, chunk)
        .withColumn(c.start, covered)
        .filter(F.col(c.end) > F.col(c.start))
        .select(*ranges.columns)
    )


def _block(code: str, shift: int | str) -> Column:
    """Block number of a code: an arithmetic shift, exact for every bigint."""
    return F.expr(f"shiftright({code}, {shift})")


def _bits(c: RangeColumns) -> Column:
    """Bits of (width - 1): two to that power is at least the width of the range."""
    width = F.try_subtract(F.col(c.end), F.col(c.start))
    return F.when(width.isNull(), 64).when(width > 1, F.length(F.bin(width - 1))).otherwise(0)


def _class(c: RangeColumns) -> Column:
    """Block size of a range by its own width, in steps of four bits, at most 60: few sizes
    occur, and a range touches 17 blocks at most."""
    return F.least(F.ceil(_bits(c) / 4) * 4, F.lit(60)).cast("int")


def _match_by_broadcast(points: DataFrame, lookup: RangeLookup, how: str) -> DataFrame:
    c = lookup.columns
    if how == "inner":
        # a point probes one block per size, so a few wide ranges cost narrow ones nothing
        sized = lookup.ranges.withColumn("_shift", _class(c))
        touched = F.sequence(_block(c.start, "_shift"), _block(f"{c.end} - 1", "_shift"))
        blocks = F.broadcast(sized.withColumn("_block", F.explode(touched)))
        probes = points.withColumn(
            "_shift", F.explode(F.array(*(F.lit(k) for k in lookup.classes)).cast("array<int>"))
        ).withColumn("_block", _block(c.point, "_shift"))
        matched = probes.alias("p").join(blocks.alias("r"), _condition(c, [*c.keys, "_shift", "_block"]))
        return matched.select(*_columns("p", points.columns), F.col(f"r.{c.value}"))
    first, last = _block(c.start, lookup.shift), _block(f"{c.end} - 1", lookup.shift)
    blocks = lookup.ranges.withColumn("_block", F.explode(F.sequence(first, last)))
    left = points.withColumn("_block", _block(c.point, lookup.shift)).alias("p")
    right = F.broadcast(blocks).alias("r")
    matched = left.join(right, _condition(c, [*c.keys, "_block"]), how)
    return matched.select(*_columns("p", points.columns), F.col(f"r.{c.value}"))


def _match_by_map(
    points: DataFrame, lookup: RangeLookup, how: str, unique_by: list[str] | None
) -> DataFrame:
    """Join with the point map, with hot codes split.

    A point's place among the pieces of its code depends on its content alone, so that a
    task run again after a lost executor sends every row where it went before. Copies
    would all get the same place; they are counted instead, and the counts split.
    """
    c = lookup.columns
    code, columns = [*c.keys, c.point], points.columns
    if unique_by is None:
        packed, content = points.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")), columns
    else:
        packed, content = points.withColumn("_copies", F.lit(1).cast("bigint")), unique_by

    counts = (
        packed.filter(F.col(c.point).isNotNull()).groupBy(*code).agg(F.sum("_copies").alias("_n"))
    )
    total = packed.agg(F.coalesce(F.sum("_copies"), F.lit(1))).scalar()
    piece = F.ceil(total / F.lit(float(lookup.pieces)))
    # fewer than ``pieces`` codes can hold more than that share each
    hot = F.broadcast(
        counts.filter(F.col("_n") > piece).select(*code, F.ceil(F.col("_n") / piece).alias("_pieces"))
    )
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    right = (
        point_map(counts.select(*code), lookup)
        .join(hot, code, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)))
    )
    parts = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("_copies") / piece) - 1)
    # a missing code matches nothing and may go anywhere
    places = F.when(F.col(c.point).isNull(), F.lit(lookup.pieces)).otherwise(pieces)
    left = (
        packed.withColumn("_piece", piece)
        .withColumn("_part", F.explode(parts))
        .withColumn("_copies", F.least("_piece", F.col("_copies") - F.col("_part") * F.col("_piece")))
        .join(hot, code, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*content, "_part"), places))
    )
    matched = left.alias("p").join(right.alias("r"), _equal([*code, "_salt"]), how)
    found = matched.select(*_columns("p", [*columns, "_copies"]), F.col(f"r.{c.value}"))
    if unique_by is not None:
        return found.drop("_copies")
    one_each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    return found.withColumn("_copy", one_each).select(*columns, c.value)


def point_map(codes: DataFrame, lookup: RangeLookup) -> DataFrame:
    """Distinct (keys, point) with the value of each range around it.

    Ranges are cut into blocks by their own width: a range of at most ``2**20`` codes
    touches two blocks at most, so neither a few very wide ranges nor a dense area of
    narrow ones makes a block expensive. A code probes one block per block size that
    occurs, at most 64.
    """
    c = lookup.columns
    code = [*c.keys, c.point]
    bits = _bits(c)
    sized = lookup.ranges.withColumn(
        "_shift", F.greatest(F.least(bits, F.lit(BLOCK_BITS)), bits - SPAN_BITS)
    )
    touched = F.sequence(_block(c.start, "_shift"), _block(f"{c.end} - 1", "_shift"))
    blocks = sized.withColumn("_block", F.explode(touched))
    sizes = sized.agg(F.collect_set("_shift")).scalar()
    probes = codes.withColumn("_shift", F.explode(sizes)).withColumn(
        "_block", _block(c.point, "_shift")
    )
    on = _condition(c, [*c.keys, "_shift", "_block"])
    return (
        probes.alias("p")
        .join(blocks.alias("r"), on, "inner")
        .select(*_columns("p", code), F.col(f"r.{c.value}"))
    )


def _columns(side: str, names) -> list[Column]:
    return [F.col(f"{side}.`{name}`") for name in names]


def _equal(names) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & (F.col(f"p.{name}") == F.col(f"r.{name}"))
    return condition


def _condition(c: RangeColumns, equal: list[str]) -> Column:
    code = F.col(f"p.{c.point}")
    return _equal(equal) & (code >= F.col(f"r.{c.start}")) & (code < F.col(f"r.{c.end}"))
