"""Mixing sources to target weights by entropy balancing (after Hainmueller, 2012).

Each source has a target number of words. Document rates r minimise the relative entropy
``sum r ln r - r + 1`` under one constraint per source, ``sum size * r = target``, and the
bound ``r <= 3``. The dual is convex with one multiplier per source, and its solution is an
exponential tilt: ``r = min(3, exp(multiplier * size / mean size))``. Newton steps on all
multipliers at once are sums over the data, kept inside a bracket that only shrinks, so
they end at the root wherever they start.

A rate depends on a document's source and size only, so the sums run over (source, size)
pairs, which are far fewer than documents. Sums that a result depends on are decimals:
they come out the same in whatever order partitions arrive.

Rates become whole copies by systematic rounding along sizes: copies of the documents up
to any point differ from the sum of their rates by less than one, so a source's words
differ from its target by about one document, and moving up to three documents by one
copy takes most of that away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.llm.durable import durable

WEIGHTS = (5, 2, 1)
MOST = 3  # times a document, and a source, may be taken
STEPS = 60
TOLERANCE = 1e-9
# documents of one source and size are numbered in parts of about this many
PART = 1_000_000
CORRECTIONS = 3  # documents of a source moved by one copy after rounding
RATE_UNITS = 10**9  # rates are whole billionths from here on


def word_count(text):
    """Runs without space and \\t\\n\\v\\f\\r; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of ``sources(source, source_size)``.

    Weights repeat over the sources by code point, null last. They share the words of all
    sources; a target stops at ``most`` times its source's size, and the excess is shared
    again among the others by weight until none is above. Sources in order of size per
    weight stop first, so one running sum finds the level at which the others stay.
    Sources without words get nothing.
    """
    # one row per source: a table of names, not of documents
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn(
        "weight",
        F.element_at(
            F.array(*(F.lit(float(w)) for w in weights)),
            ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"),
        ),
    ).withColumn("room", F.lit(float(most)) * F.col("source_size"))
    by_room = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(rest)
    return (
        ranked.withColumn("level", level)
        .withColumn("full", F.col("level") * F.col("weight") >= F.col("room"))
        # the level holds from the first source that is not full
        .withColumn("level", F.first(F.when(~F.col("full"), F.col("level")), True).over(everything))
        .select(
            "source", "source_size",
            F.least("room", F.coalesce("level", F.col("room")) * F.col("weight")).alias("target"),
        )
    )


def _rates(sizes: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """(source, multiplier): the dual's solution, by bracketed Newton steps.

    ``sizes`` has (source, size, n) with size over 0.
    """
    tilt = F.col("multiplier") * F.col("size") / F.col("mean")
    rate = F.least(F.lit(float(most)), F.exp(F.least(tilt, F.lit(50.0))))
    exact = "decimal(38,6)"
    means = sizes.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean")
    )
    state = durable(
        targets.alias("t").join(means.alias("m"), F.equal_null("t.source", "m.source"))
        .select(
            "t.source", "mean", "target",
            F.lit(0.0).alias("multiplier"), F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"),
        )
    )
    for _ in range(STEPS):
        data = sizes.alias("d").join(state.alias("m"), F.equal_null("d.source", "m.source"))
        sums = data.groupBy("m.source").agg(
            F.sum((F.col("size") * F.col("n") * rate).cast(exact)).cast("double").alias("words"),
            F.sum(
                F.when(rate < most, F.col("size") * F.col("size") * F.col("n") * rate / F.col("mean"))
                .otherwise(0.0).cast(exact)
            ).cast("double").alias("slope"),
            *(F.first(c).alias(c) for c in ("mean", "target", "multiplier", "low", "high")),
        )
        over = F.col("words") - F.col("target")
        newton = F.col("multiplier") - over / F.col("slope")
        moved = (
            sums.withColumn("high", F.when(over > 0, F.col("multiplier")).otherwise(F.col("high")))
            .withColumn("low", F.when(over <= 0, F.col("multiplier")).otherwise(F.col("low")))
            .withColumn("off", F.abs(over) / F.greatest(F.col("target"), F.lit(1.0)))
            .withColumn("width", F.col("high") - F.col("low"))
            .withColumn(
                "multiplier",
                F.when(F.col("off") <= TOLERANCE, F.col("multiplier"))
                .when((F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high")), newton)
                .otherwise((F.col("low") + F.col("high")) / 2),
            )
        )
        state = durable(moved.select("source", "mean", "target", "multiplier", "low", "high", "off", "width"))
        if state.where((F.col("off") > TOLERANCE) & (F.col("width") > 1e-12)).isEmpty():
            break
    return state.select("source", "mean", "multiplier")


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, rate, copies, taken) for every row of
    ``docs(doc_id, text, source)``.

    ``size`` is the text's words, ``copies`` how often the mix takes the text and ``taken``
    the words that gives. Null and blank texts have size 0 and are not taken; a null
    source is a source; repeated rows are documents of their own, told apart by nothing,
    so which of them gets a copy more is not defined but how many do is; rows without
    doc_id count as others; an empty table gives none. Reruns agree.
    """
    light = durable(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    totals = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = durable(source_targets(totals, weights, most))
    sizes = durable(light.groupBy("source", "size").agg(F.count("*").alias("n")))
    solved = _rates(sizes.where("size > 0"), targets.where("source_size > 0"), most)
    tilt = F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0))
    units = F.when(
        F.col("size") > 0, F.round(F.least(F.lit(float(most)), F.exp(tilt)) * RATE_UNITS)
    ).otherwise(0)
    # rates up to each size: one row per source and size
    upto = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = (
        sizes.alias("d").join(targets.alias("s"), F.equal_null("d.source", "s.source"))
        .join(solved.alias("m"), F.equal_null("d.source", "m.source"), "left")
        .select("d.source", "size", "n", "source_size", "target", units.cast("decimal(38,0)").alias("rate"))
        .withColumn("before", F.coalesce(F.sum(F.col("rate") * F.col("n")).over(upto), F.lit(0)).cast("decimal(38,0)"))
    )
    # the number of a document among those of its source and size: parts of these first
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / PART))
    placed = durable(
        light.alias("l").join(
            rated.alias("r"), F.equal_null("l.source", "r.source") & (F.col("l.size") == F.col("r.size"))
        ).select(
            "l.doc_id", "l.source", "l.size", "source_size", "target", "rate", "before",
            F.pmod(F.xxhash64("l.doc_id"), parts).alias("part"),
        )
    )
    in_order = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("source", "size", "part").agg(F.count("*").alias("m")).withColumn(
        "first", F.coalesce(F.sum("m").over(in_order), F.lit(0))
    )
    within = Window.partitionBy("l.source", "l.size", "l.part").orderBy(F.xxhash64("l.doc_id"), "l.doc_id")
    number = F.col("first") + F.row_number().over(within) - 1
    # half a unit of shift, so that a sum of rates is rounded and not cut
    mass = (F.col("before") + F.col("rate") * number + RATE_UNITS // 2).cast("decimal(38,0)")
    copied = durable(
        placed.alias("l").join(
            first.alias("f"),
            F.equal_null("l.source", "f.source")
            & (F.col("l.size") == F.col("f.size")) & (F.col("l.part") == F.col("f.part")),
        )
        .select("l.doc_id", "l.source", "l.size", "source_size", "target", "rate", mass.alias("mass"))
        .withColumn("copies", F.expr(f"(mass + rate) div {RATE_UNITS} - mass div {RATE_UNITS}"))
        .withColumn("row", F.monotonically_increasing_id())
        .drop("mass")
    )
    moved = _corrections(copied, targets, most)
    copies = F.col("copies") + F.coalesce("move", F.lit(0))
    return copied.join(moved, "row", "left").select(
        "doc_id", "size", "source_size", "target",
        (F.col("rate").cast("double") / RATE_UNITS).alias("rate"),
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def _corrections(copied: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """(row, move): documents that get one copy more or less, a few for each source.

    What rounding leaves of a source's target is nearest to the size of some document;
    each round moves that one, if it brings the source nearer.
    """
    choices = durable(
        copied.groupBy("source", "size", "copies")
        .agg(
            F.min_by("row", F.struct(F.xxhash64("doc_id"), "doc_id")).alias("row"),
            F.count("*").alias("n"),
        )
    )
    taken = choices.groupBy("source").agg(F.sum(F.col("size") * F.col("copies") * F.col("n")).alias("taken"))
    left = durable(
        targets.alias("t").join(taken.alias("c"), F.equal_null("t.source", "c.source"))
        .select("t.source", (F.col("target") - F.col("taken")).alias("left"))
    )
    moves = None
    for _ in range(CORRECTIONS):
        sign = F.signum("left").cast("long")
        fits = (F.col("copies") + sign).between(0, most) & (F.col("size") > 0)
        gap = F.abs(F.abs("left") - F.col("size"))
        best = durable(
            choices.alias("c").join(left.alias("f"), F.equal_null("c.source", "f.source"))
            .where(fits & (gap < F.abs("left")))
            .groupBy("f.source")
            .agg(F.min(F.struct(gap.alias("gap"), "size", "copies", "row", sign.alias("move"))).alias("best"))
            .select("source", "best.size", "best.row", "best.move")
        )
        picked = best.select("row", "move")
        moves = picked if moves is None else moves.unionByName(picked)
        choices = choices.join(picked, "row", "left_anti")
        left = left.alias("f").join(best.alias("b"), F.equal_null("f.source", "b.source"), "left").select(
            "f.source", (F.col("left") - F.coalesce(F.col("move") * F.col("size"), F.lit(0))).alias("left")
        )
    return moves


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents that the mix takes, with ``size``, ``source_size``, ``target``,
    ``copies`` and ``taken`` beside their own columns. Columns of ``docs`` with these names
    give way. A doc_id stands for one row; rows without doc_id cannot be told apart and are
    not taken."""
    names = ("size", "source_size", "target", "copies", "taken")
    plan = mix(docs.where("doc_id is not null"), weights, most).where("copies > 0").select("doc_id", *names)
    return docs.drop(*names).join(plan.dropDuplicates(["doc_id"]), "doc_id").select(
        *(c for c in docs.columns if c not in names), *names
    )
