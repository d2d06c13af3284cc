"""Token counts of documents through a cache of content digests.

The cache is a Parquet table (version, digest, n_tokens): version tells the tokenizer file,
its library and its settings apart, digest is the SHA-256 of a text as the tokenizer sees it.
Documents meet the cache by digest; each distinct text that is not there is encoded once,
by one of the documents that have it, and its count is appended. A digest that was appended
twice (two runs at once) counts once.

Within a task texts are encoded in parts, cut where no token can cross; parts met before are
not encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.durable import stored
from demandloom.llm.tokenizers import TokenizerFile
from demandloom.llm.words import slices

CACHE = "version string, digest binary, n_tokens long"
SLICE_BYTES = 1 << 20  # of texts encoded at once
KNOWN_PARTS = 1 << 20  # parts of texts whose counts a task remembers


def content_digest(text: Column, tokenizer: TokenizerFile) -> Column:
    """Digest of the normalised text. Null counts as empty; where the tokenizer folds white
    space, runs of spaces, tabs and line ends count as one space."""
    known = F.coalesce(text, F.lit(""))
    if tokenizer.folds_space:
        known = F.regexp_replace(known, r"[ \t\r\n]+", " ")
    return F.unhex(F.sha2(known.cast("binary"), 256))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; an absent cache is begun empty."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
        rows = spark.read.schema(CACHE).parquet(cache)
    return rows.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encoder(tokenizer: TokenizerFile):
    out = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # rows given twice meet in one task
        known: dict[str, int] = {}  # most parts of texts are words met before
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            new = [i for i, d in enumerate(digests) if not (d in seen or seen.add(d))]
            batch = batch.take(pa.array(new, pa.int64()))
            texts = batch.column("text")
            for start, length in slices(texts, SLICE_BYTES):
                parts = [tokenizer.words(t) for t in pc.fill_null(texts.slice(start, length), "").to_pylist()]
                unmet = list({p for text in parts for p in text if p not in known})
                known.update(zip(unmet, map(len, tokenizer.encode(unmet))))
                counts = [sum(map(known.__getitem__, text)) for text in parts]
                if len(known) > KNOWN_PARTS:
                    known.clear()
                digests = batch.column("digest").slice(start, length)
                yield pa.RecordBatch.from_arrays([digests.cast(pa.binary()), pa.array(counts, pa.int64())], schema=out)

    return encode


def token_counts(docs: DataFrame, tokenizer: TokenizerFile, cache: str, limit: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens[, over_limit]) of every row, and the cache completed.

    Whole texts are encoded, without begin, end or other added tokens. Null and empty texts
    have 0 bytes and 0 tokens; equal texts are encoded once; a row given twice is returned
    twice; rows without doc_id are counted as well; an empty table gives no rows; other
    columns are left out.
    """
    spark, version = docs.sparkSession, tokenizer.version
    texts = docs.select("doc_id", "text").withColumn("digest", content_digest(F.col("text"), tokenizer))
    keys = stored(
        texts.select("doc_id", "digest", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")),
        "digests",
    )
    # one document stands for each distinct text that the cache lacks; narrow rows only
    missing = (
        keys.groupBy("digest").agg(F.min(F.struct("doc_id")).alias("one"))
        .join(read_cache(spark, cache, version), "digest", "left_anti")
        .select(F.col("digest").alias("wanted"), F.col("one.doc_id").alias("of"))
    )
    # meeting by document as well keeps a text with very many copies out of one task
    chosen = texts.join(
        missing.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("wanted")), "left_semi"
    )
    new = chosen.select("digest", "text").mapInArrow(_encoder(tokenizer), "digest binary, n_tokens long")
    new.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counted = keys.join(read_cache(spark, cache, version), "digest").select("doc_id", "n_bytes", "n_tokens")
    return counted if limit is None else counted.withColumn("over_limit", F.col("n_tokens") > limit)
