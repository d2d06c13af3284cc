"""WARC archives written from pages, and read back in splits by boundary-chain verification.

Archives are plain files of records, each task of the writer making one. A reader of a
split sees the magic of a record's first line, but so may a payload hold it. So each place of
the magic, with a version behind it, is only a candidate: with its header's Content-Length it
names its successor. Pointer
jumping from the start of each file keeps the candidates that a chain of records reaches;
magic inside payloads is not among them, whatever follows it.

The text reader with the magic as its line separator yields the pieces between candidates,
split by Spark; their lengths in bytes, summed by file, are the offsets. A record without
magic inside is one piece, and its payload is hashed where it is read. Pieces of other
records are fetched by a second read and joined.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.llm.durable import durable

MAGIC = "WARC/1."
VERSIONS = ("0", "1")  # of records that are read; 1.1 is written
END = "\r\n\r\n"
PAGE_URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# base 32 digits of conv() and, in the same places, of RFC 4648
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# revisits up to this many are joined by broadcast (two numbers each), more by a shuffle
BROADCAST_ROWS = 500_000
SALTS = 16


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four digits of base 32."""
    hex_digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hex_digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def _revisits(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, response): pages whose payload a page of larger id has as well."""
    light = pages.select(
        "page_id", F.octet_length("payload").alias("bytes"), base32_sha1(F.col("payload")).alias("digest"),
        F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).alias("salt"),
    ).where(F.col("bytes") >= least)
    # a payload may be a third of all rows: counted before it moves, and joined in parts
    several = (
        light.groupBy("digest", "bytes").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "bytes", "response", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    return (
        light.join(several, ["digest", "bytes", "salt"])
        .where("page_id < response").select("page_id", "response").distinct()
    )


def write_archives(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One WARC record per row of ``pages(page_id, url, html)`` into files under ``path``.

    The payload is the html in UTF-8; null is empty. Of equal payloads of ``least`` bytes
    or more, the largest page_id is a response and the others are revisits, which refer to
    it and hold no block but name digest and length of the payload. Rows without page_id
    are responses; a row given twice is written twice; a url may be null.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    revisits = durable(_revisits(pages, least))
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    length = F.octet_length("payload").cast("string")
    is_revisit = F.col("response").isNotNull()

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    header = F.concat(
        F.lit(f"{MAGIC}{VERSIONS[-1]}\r\n"),
        field("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit(f"<{PAGE_URN}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        field("WARC-Profile", F.when(is_revisit, PROFILE)),
        field("WARC-Refers-To", F.concat(F.lit(f"<{PAGE_URN}"), F.col("response").cast("string"), F.lit(">"))),
        field("X-Payload-Length", F.when(is_revisit, length)),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(is_revisit, "0").otherwise(length)),
        F.lit("\r\n"),
    )
    block = F.when(is_revisit, "").otherwise(F.col("payload"))
    pages.join(revisits, "page_id", "left").select(F.concat(header, block).alias("value")).write.text(
        path, lineSep=END
    )


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two places of the magic, with file and start of its split."""
    return spark.read.text(path, lineSep=MAGIC).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value", F.octet_length("value").alias("bytes"),
        F.xxhash64("value").alias("hash"),
    )


def _fields(header: Column) -> list[Column]:
    def field(name: str, pattern: str) -> Column:
        found = F.regexp_extract(header, rf"(?im)^{name}:[ \t]*{pattern}[ \t]*\r?$", 1)
        return F.when(found != "", found)

    return [
        field("Content-Length", r"(\d{1,18})").cast("long").alias("length"),
        field("WARC-Type", r"(\S+)").alias("record_type"),
        field("WARC-Record-ID", r"(\S+)").alias("record_id"),
        field("WARC-Target-URI", r"(\S+)").alias("url"),
        field("WARC-Refers-To", r"(\S+)").alias("refers_to_id"),
        field("WARC-Payload-Digest", r"sha1:(\S+)").alias("declared_digest"),
        field("X-Payload-Length", r"(\d{1,18})").cast("long").alias("declared_bytes"),
    ]


def _payload(value: Column, header_bytes: Column, length: Column) -> Column:
    return F.substring(value.cast("binary"), header_bytes.cast("int") + len(END) + 1, length.cast("int"))


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that a chain from offset 0 of their file reaches.

    ``candidates`` has (file, split, offset, successor) with successor > offset. Within a
    split, which is of bounded size, jumping pointers finds where the chain of each
    candidate leaves it. Those that a chain enters a split by, a few per split, are then
    the nodes of each file's chain of splits. Last, the candidates that a split's reached
    entries lead to are marked. Each jump doubles its length, so a chain of n records takes
    the logarithm of n rounds.
    """
    nodes = durable(candidates)
    leaving = durable(
        nodes.groupBy("file", "split").applyInPandas(_exits, "file string, split long, offset long, successor long")
    )
    landings = leaving.select("file", F.col("successor").alias("offset"), F.lit(True).alias("landing")).distinct()
    between = leaving.join(landings, ["file", "offset"], "left").where("offset = 0 or landing")
    entries = between.withColumn("entry", F.col("offset") == 0).groupBy("file").applyInPandas(
        _marked, "file string, split long, offset long"
    )
    reached = entries.groupBy("file", "split")
    return nodes.groupBy("file", "split").cogroup(reached).applyInPandas(_entered, "file string, offset long")


def _inside(nodes: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """A split's candidates by offset, and the place of each one's successor among them, or
    one past the last where it is not among them."""
    nodes = nodes.drop_duplicates("offset").sort_values("offset")
    offsets, after = nodes["offset"].to_numpy(), nodes["successor"].to_numpy()
    place = np.searchsorted(offsets, after)
    found = (place < len(offsets)) & (offsets[np.minimum(place, len(offsets) - 1)] == after)
    return nodes, np.where(found, place, len(offsets))


def _exits(nodes: pd.DataFrame) -> pd.DataFrame:
    """Each candidate with the successor that its chain leaves the split by."""
    nodes, place = _inside(nodes)
    own = np.arange(len(nodes))
    last = np.where(place < len(nodes), place, own)
    while (last[last] != last).any():
        last = last[last]
    return nodes[["file", "split", "offset"]].assign(successor=nodes["successor"].to_numpy()[last])


def _marked(nodes: pd.DataFrame) -> pd.DataFrame:
    """The candidates that chains from those with ``entry`` lead to."""
    nodes, place = _inside(nodes)
    end = len(nodes)
    jump = np.append(place, end)
    hit = np.append(nodes["entry"].to_numpy(bool), False)
    for _ in range(max(1, end).bit_length()):
        hit[jump[hit]] = True
        hit[end] = False
        jump = jump[jump]
    return nodes.loc[hit[:end], ["file", "split", "offset"]]


def _entered(nodes: pd.DataFrame, reached: pd.DataFrame) -> pd.DataFrame:
    if nodes.empty or reached.empty:
        return pd.DataFrame({"file": pd.Series([], dtype=str), "offset": pd.Series([], dtype="int64")})
    return _marked(nodes.assign(entry=nodes["offset"].isin(reached["offset"])))[["file", "offset"]]


def page_of(record_id: Column) -> Column:
    """The page_id in an id that ``write_archives`` gave a record; null for others'."""
    found = F.regexp_extract(record_id, rf"^<{PAGE_URN}(-?\d+)>$", 1)
    return F.when(found != "", found).cast("long")


def read_archives(spark: SparkSession, path: str, payloads: bool = False, resolve: bool = False) -> DataFrame:
    """(file, offset, record_id, page_id, url, record_type, refers_to_id, refers_to,
    payload_bytes, payload_digest, intact) of every record, of version 1.0 or 1.1, that the
    chains of the files under ``path`` reach; with ``payloads`` also ``payload``, the block's
    bytes.

    Ids are as the archive has them; page_id and refers_to are the pages that ids of
    ``write_archives`` name, else null. Digest and length are those of the payload found; a
    revisit, which has none, gives those it names, and with ``resolve`` the payload of the
    record it refers to. ``intact`` tells that a payload has the digest its record names, and
    is null where it names none by SHA-1. A record that its file's end cuts off is left out,
    and so is all behind it; a file that does not begin with a record, and an empty folder of
    archives, give no rows.
    """
    size = len(MAGIC)
    header = F.when(
        (F.instr("value", END) > 0) & F.substring("value", 1, 3).isin(*(f"{v}\r\n" for v in VERSIONS)),
        F.substring_index("value", END, 1),
    )
    pieces = _pieces(spark, path).withColumn("header", header).select(
        "file", "split", "at", "bytes", "hash", "value",
        F.octet_length("header").alias("header_bytes"), *_fields(F.col("header")),
    )
    whole = F.col("bytes") == F.col("header_bytes") + F.col("length") + 2 * len(END)
    block = F.when(F.col("whole"), _payload(F.col("value"), F.col("header_bytes"), F.col("length")))
    pieces = durable(
        pieces.withColumn("whole", F.coalesce(whole, F.lit(False))).withColumn("payload", block)
        .withColumn("digest", base32_sha1(F.col("payload")))
        .drop("value", *(() if payloads else ("payload",)))
    )
    # offsets: pieces within a split, splits within a file
    within = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = pieces.groupBy("file", "split").agg(F.sum(F.col("bytes") + size).alias("all")).select(
        "file", "split", F.coalesce(F.sum("all").over(across), F.lit(0)).alias("before")
    )
    placed = durable(
        pieces.withColumn("inside", F.coalesce(F.sum(F.col("bytes") + size).over(within), F.lit(0)))
        .join(splits, ["file", "split"])
        .withColumn("offset", F.col("before") + F.col("inside") - size)
        .drop("at", "before", "inside")
    )
    end = F.col("offset") + size + F.col("header_bytes") + len(END) + F.col("length") + len(END)
    candidates = placed.where("offset >= 0 and length is not null").select("file", "split", "offset", end.alias("successor"))
    chain = reachable(candidates).withColumn("reached", F.lit(True))
    records = durable(placed.join(chain, ["file", "offset"], "left").drop("split"))
    found = records.where("reached and whole")
    if not records.where("reached and not whole").isEmpty():
        found = found.unionByName(_joined(spark, path, records, payloads))
    revisit = F.coalesce(F.col("record_type") == "revisit", F.lit(False))
    found = found.select(
        "file", "offset", "record_id", page_of(F.col("record_id")).alias("page_id"), "url", "record_type",
        "refers_to_id", page_of(F.col("refers_to_id")).alias("refers_to"),
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        (revisit | (F.col("digest") == F.col("declared_digest"))).alias("intact"),
        *(["payload"] if payloads else []),
    )
    return _resolved(found) if payloads and resolve else found


def _resolved(found: DataFrame) -> DataFrame:
    """Records whose revisits have the payload of the record they refer to.

    A response may be referred to by a third of all records: both sides are joined in parts."""
    found = found.withColumn("_salt", F.pmod(F.xxhash64("file", "offset"), F.lit(SALTS)))
    revisits, others = found.where("record_type = 'revisit'"), found.where("record_type is null or record_type <> 'revisit'")
    wanted = revisits.select(F.col("refers_to_id").alias("_id")).distinct()
    named = (
        others.join(wanted, F.col("record_id") == F.col("_id"), "left_semi")
        .groupBy(F.col("record_id").alias("_id")).agg(F.first("payload").alias("_payload"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    met = revisits.join(named, (F.col("refers_to_id") == F.col("_id")) & (F.col("_salt") == F.col("_part")), "left")
    filled = met.withColumn("payload", F.col("_payload")).select(*found.columns)
    return others.unionByName(filled).drop("_salt")


def _joined(spark: SparkSession, path: str, records: DataFrame, payloads: bool) -> DataFrame:
    """Records of several pieces: their payloads hold the magic.

    Every piece belongs to the last record that begins at or before it. Only the pieces of
    such records are read again, found by length and hash.
    """
    # one row per piece, without its text
    upto = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = records.where("offset >= 0").select(
        "file", "offset", "bytes", "hash",
        F.last(F.when(F.col("reached"), F.struct("offset", "whole")), True).over(upto).alias("owner"),
    ).where("not owner.whole")
    owned = durable(owned)
    wanted = owned.select("bytes", "hash").distinct()
    if owned.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    again = _pieces(spark, path).select("bytes", "hash", "value").join(wanted, ["bytes", "hash"], "left_semi")
    found = owned.select("file", "offset", "owner", "bytes", "hash").join(
        again.dropDuplicates(["bytes", "hash"]), ["bytes", "hash"]
    )
    bodies = found.groupBy("file", F.col("owner.offset").alias("offset")).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]), MAGIC
        ).alias("value")
    )
    return (
        records.where("reached and not whole").drop("payload").join(bodies, ["file", "offset"])
        .where(F.octet_length("value") >= F.col("header_bytes") + len(END) + F.col("length"))
        .withColumn("payload", _payload(F.col("value"), F.col("header_bytes"), F.col("length")))
        .withColumn("digest", base32_sha1(F.col("payload")))
        .drop("value", *(() if payloads else ("payload",)))
    )
