"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

A vector is a sparse row of terms (its components) and integer weights. Candidates are
read in blocks. A block is turned into postings, term by term: the rows that have the term
and their weights. Each term of each query then scatters its weight times the postings into
a dense array of scores, one place per candidate of the block. Of the array, the k best are
selected, ties by id, and merged: within a task, and then once per query over all tasks.

Every query meets every candidate, so nothing is missed and nothing is tuned. Queries go to
the tasks in groups of bounded size, one pass over the candidates per group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# queries of a group, queries and candidates of one array of scores
GROUP = 20_000
QUERY_BLOCK = 128
BLOCK = 4096
SCALE = 256


def integer_terms(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as double; null if any is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * scale)))


def _postings(rows: pa.Array, terms: int) -> np.ndarray:
    """Weights of a block, a row per term: the candidates of a term are those not zero."""
    lengths = pc.list_value_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(rows)), lengths)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    known = term < terms
    weights = np.zeros((terms, len(rows)), np.float64)
    weights[term[known], owner[known]] = flat[known]
    return weights


def _accumulate(queries: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores of all queries and candidates, one term after the other."""
    # sums of integers: exact in 32 bits to 2**24, in 64 to 2**53, beyond that in integers
    most = np.abs(queries).max(axis=0, initial=0) @ np.abs(weights).max(axis=1, initial=0)
    if most >= 2**63:
        raise OverflowError("an inner product may not fit in 64 bits: use a smaller scale")
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    queries, weights = queries.astype(kind), weights.astype(kind)
    scores = np.zeros((len(queries), weights.shape[1]), kind)
    part = np.empty_like(scores)
    for term in range(len(weights)):
        has = np.flatnonzero(queries[:, term])
        ids = np.flatnonzero(weights[term])
        if len(has) == len(queries) and len(ids) * 2 > weights.shape[1]:
            np.multiply(queries[:, term, None], weights[term], out=part)
            scores += part
        elif len(has) and len(ids):
            scores[np.ix_(has, ids)] += queries[has, term, None] * weights[term, ids]
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of each row's k best, and all that tie with the last of them."""
    if scores.shape[1] <= k:
        rows, places = np.indices(scores.shape).reshape(2, -1)
        return rows, places
    last = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    return np.nonzero(scores >= last[:, None])


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 5, scale: int = SCALE, group: int = GROUP
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products.

    Both tables have (vec_id, embedding). Ties go to the smaller vec_id; candidates with
    the query's id are left out. Vectors that are null or hold a null or non-finite
    component, and rows without vec_id, take no part; where lengths differ, missing
    components count 0, so an empty vector scores 0; products beyond 64 bits are an error. Of queries that share an id one is
    searched; candidates given twice are found twice. Empty tables give no rows.
    """
    terms = integer_terms(F.col("embedding"), scale)
    asked = queries.where("vec_id is not null").select("vec_id", terms.alias("terms")).where("terms is not null")
    asked = asked.groupBy("vec_id").agg(F.min("terms").alias("terms"))
    known = candidates.where("vec_id is not null").select("vec_id", terms.alias("terms")).where("terms is not null")
    groups = max(1, math.ceil(asked.count() / group))
    found = None
    for g in range(groups):
        # about ``group`` queries, the bound on what travels with a pass
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).orderBy("vec_id").toArrow()
        if part.num_rows:
            block = _pass(known, part, k)
            found = block if found is None else found.unionByName(block)
    if found is None:
        found = known.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _pass(known: DataFrame, part: pa.Table, k: int) -> DataFrame:
    """The k best of every task's candidates, for the queries of one group."""
    rows = part.column("terms").combine_chunks()
    width = int(pc.max(pc.list_value_length(rows)).as_py() or 0)
    weights = _postings(rows, width).T
    shared = known.sparkSession.sparkContext.broadcast((np.array(part.column("vec_id")), weights))

    def run(batches):
        ids, asked = shared.value
        best = {"q": np.zeros(0, np.int64), "v": np.zeros(0, np.int64), "s": np.zeros(0, np.int64)}

        def merged(q, v, s):
            order = np.lexsort((v, -s, q))
            q, v, s = q[order], v[order], s[order]
            firsts = np.flatnonzero(np.diff(q, prepend=-1))
            place = np.arange(len(q)) - np.repeat(firsts, np.diff(firsts, append=len(q)))
            return {"q": q[place < k], "v": v[place < k], "s": s[place < k]}

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                own = batch.slice(start, BLOCK)
                vec = own.column(0).to_numpy(zero_copy_only=False)
                postings = _postings(own.column(1), asked.shape[1])
                found = [best]
                for at in range(0, len(ids), QUERY_BLOCK):
                    scores = _accumulate(asked[at : at + QUERY_BLOCK], postings)
                    query = ids[at : at + QUERY_BLOCK]
                    mine = query[:, None] == vec  # the query's own row is no candidate
                    low = np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf
                    scores[mine] = low
                    r, c = _best(scores, vec, k)
                    real = ~mine[r, c]
                    r, c = r[real], c[real]
                    found.append({"q": r + at, "v": vec[c], "s": scores[r, c].astype(np.int64)})
                best = merged(*(np.concatenate([f[x] for f in found]) for x in "qvs"))
        if len(best["q"]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[best["q"]]), pa.array(best["v"]), pa.array(best["s"])], ["query_id", "vec_id", "score"]
            )

    return known.mapInArrow(run, "query_id long, vec_id long, score long")
