"""Exact top-k by inner product: the k-th score of every query is found from global score histograms.

All candidates are scored against a block of queries, and only counts per score
interval leave a task. The interval that holds a query's k-th score is cut anew
until it is one integer wide. Then the scores above it are kept, with the
smallest ids of those equal to it, so a vector that a third of all rows share
sends at most k rows per task and query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwing.llm.common import stored

BINS = 256
QUERY_BLOCK = 1_024      # queries of a pass; their vectors and bounds are all that the driver holds
CANDIDATES = 1_024       # vectors scored at once


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) as longs; vectors with null or non-finite parts and rows without id go."""
    valid = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: (
        x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return vectors.filter(valid).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors continue with zeros, exact in double below 2**53."""
    lengths = pc.list_value_length(column).to_numpy()
    flat = column.flatten().to_numpy()
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width).astype(float)
    out = np.zeros((len(lengths), width))
    start = 0
    for row, length in enumerate(lengths.tolist()):
        out[row, :min(length, width)] = flat[start:start + min(length, width)]
        start += length
    return out


def _scores(queries: np.ndarray, batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(candidate ids, scores by query and candidate) in blocks."""
    for batch in batches:
        for start in range(0, batch.num_rows, CANDIDATES):
            part = batch.slice(start, CANDIDATES)
            values = _matrix(part.column("v"), queries.shape[1])
            yield part.column("vec_id").to_numpy(), (queries @ values.T).astype(np.int64)


def _count(ids: np.ndarray, queries: np.ndarray, low: np.ndarray, span: np.ndarray,
           batches) -> Iterator[pa.RecordBatch]:
    """Candidates of this task per query and interval."""
    held = np.zeros((len(ids), BINS), np.int64)
    rows = np.arange(len(ids))[:, None]
    width = -(-span // BINS)
    for own, scores in _scores(queries, batches):
        slot = (scores - low[:, None]) // width[:, None]
        inside = (scores >= low[:, None]) & (scores < (low + span)[:, None]) & (own[None, :] != ids[:, None])
        held += np.bincount((rows * BINS + slot)[inside], minlength=held.size).reshape(held.shape)
    q, b = np.nonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(held[q, b])],
                                     names=["q", "slot", "n"])


def _select(ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int, batches) -> Iterator[pa.RecordBatch]:
    """Scores above the k-th, and of the equal ones those with the smallest ids."""
    for own, scores in _scores(queries, batches):
        out = []
        other = own[None, :] != ids[:, None]
        q, c = np.nonzero((scores > kth[:, None]) & other)
        out.append((q, own[c], scores[q, c]))
        order = np.argsort(own, kind="stable")
        equal = ((scores == kth[:, None]) & other)[:, order]
        equal &= np.cumsum(equal, axis=1) <= k
        q, c = np.nonzero(equal)
        out.append((q, own[order[c]], kth[q]))
        q, vec, score = (np.concatenate(x) for x in zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(q.astype(np.int64)), pa.array(vec), pa.array(score)],
                                         names=["query_id", "q", "vec_id", "score"])


def _kth(spread: DataFrame, need: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Per query the interval that holds its k-th score, and how many scores lie above it."""
    rows = spread.groupBy("q", "slot").agg(F.sum("n").alias("n"))
    wanted = spread.sparkSession.createDataFrame(sorted(need.items()), "q long, need long")
    down = Window.partitionBy("q").orderBy(F.desc("slot"))
    summed = rows.join(F.broadcast(wanted), "q").withColumn("upto", F.sum("n").over(down))
    first = summed.filter("upto >= need").groupBy("q").agg(F.min(F.struct("upto", "slot", "n")).alias("x"))
    return {r[0]: (r[1]["slot"], r[1]["upto"] - r[1]["n"]) for r in first.collect()}


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k highest scores of each query, ties to the smaller vec_id.

    Both frames are (vec_id, v) as `quantized` makes them; a query's own id is no
    candidate. Fewer candidates than k: all of them. A query row that repeats
    counts once; of a repeated query id with several vectors each has its own
    ranks; a candidate row that repeats is found as often as it stands there.
    Scores are exact while they stay below 2**53.
    """
    spark = vectors.sparkSession
    candidates = stored(vectors, "vectors")
    width, most, total = candidates.agg(
        F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs))), F.count(F.lit(1))).first()
    asked = queries.distinct().withColumn("_at", F.xxhash64("vec_id", "v"))
    schema = "query_id long, rank int, vec_id long, score long"
    if not total:
        return spark.createDataFrame([], schema)
    asked = stored(asked, "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    out = None
    for number in range(blocks):
        rows = asked.filter(F.pmod("_at", F.lit(blocks)) == number).orderBy("vec_id", "_at").collect()
        if not rows:
            continue
        ids = np.array([r["vec_id"] for r in rows], np.int64)
        matrix = np.zeros((len(rows), max(width, 1)))
        for at, r in enumerate(rows):
            matrix[at, :len(r["v"])] = r["v"]
        low = -(np.abs(matrix).sum(1).astype(np.int64) * int(most or 0)) - 1
        span = 1 - 2 * low
        need = {q: k for q in range(len(rows))}
        floor = low.copy()
        while span.max() > 1 and need:
            cell = -(-span // BINS)
            counted = candidates.mapInArrow(partial(_count, ids, matrix, low, span), "q long, slot long, n long")
            found = _kth(counted, need)
            for q in list(need):
                if q in found:
                    slot, above = found[q]
                    low[q], span[q] = low[q] + slot * cell[q], cell[q]
                    need[q] -= above
                else:      # fewer candidates than k: all count
                    del need[q]
                    low[q], span[q] = floor[q], 1
        picked = candidates.mapInArrow(partial(_select, ids, matrix, low, k),
                                       "query_id long, q long, vec_id long, score long")
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        ranked = picked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score")
        out = ranked if out is None else out.union(ranked)
    return out if out is not None else spark.createDataFrame([], schema)
