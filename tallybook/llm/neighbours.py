"""Approximate nearest neighbours by cosine, with an adaptive scan of dimensions.

Unit vectors are rotated by one random orthogonal matrix, so that any block of dimensions is a fair sample of the whole
distance. They lie in lists around centroids, and each list in blocks of rows stored by column blocks. A query goes to
its nearest lists. Within a list, distances grow column block by column block, and after each a hypothesis
test abandons the candidates whose partial distance, scaled up to all dimensions, is significantly above the query's bound:
``partial * D / d > bound * (1 + EPSILON / sqrt(d)) ** 2``. The survivors of all dimensions are compared exactly, on the
original vectors in double precision. A query's bound is its fifth best exact score in the block, so it tightens as the block is scanned.

Centroids are fitted on a bounded sample (``MOST_SAMPLED`` rows by hash); every row is indexed. The share of the lists that a query probes is
``PROBED``. Hot lists are split into blocks of ``BLOCK_ROWS`` rows and their queries into blocks too; each pair of
blocks is one small group, so that no list, nor one vector that a third of the rows share, meets in one task.

Rows whose vectors are equal bit for bit are one candidate with the smallest ids that can be in a result (``k + 1`` of them).

Defined cases: vectors that are null, empty, zero, or hold null, NaN or infinite components take no part, nor do rows without a
vec_id or vectors of another length than most; rows that repeat a vec_id count once (the least vector); a query's own row is no
candidate; with fewer than ``k`` candidates all are returned, whatever list they lie in; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallybook.llm.tables import stored

NEIGHBOURS = 5
EVERY = 50
MOST_SAMPLED = 8_000
MOST_LISTS = 256
PROBED = 0.8
LEAST_PROBED = 24
EPSILON = 2.1
COLUMN_BLOCK = 16
BLOCK_ROWS = 4_000
_ROUNDS = 8


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part, each vec_id once."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(good).groupBy("vec_id").agg(F.min("v").alias("v"))
    width = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (width["d"] if width else 0))


def _rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(11).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / scale
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _centroids(rows: DataFrame) -> np.ndarray:
    sample = rows.orderBy(F.xxhash64("v"), "vec_id").limit(MOST_SAMPLED).select("v").toArrow()
    if not sample.num_rows:
        return np.zeros((0, 0))
    x = _unit(_matrix(sample.column(0)))
    x = np.unique(x, axis=0)
    k = min(MOST_LISTS, max(1, int(np.sqrt(len(x)))))
    centre = x[np.random.default_rng(5).choice(len(x), k, replace=False)]
    for _ in range(_ROUNDS):
        own = np.argmax(x @ centre.T, axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, x)
        norm = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centre = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centre)
    return centre


def nearest(vectors: DataFrame, k: int = NEIGHBOURS, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: of each row whose vec_id is divisible by ``every`` the ``k`` nearest found."""
    rows = stored(usable(vectors), "vectors")
    centre = _centroids(rows)
    if not len(centre):
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    model = rows.sparkSession.sparkContext.broadcast((centre, _rotation(centre.shape[1])))
    lists = len(centre)
    probed = min(lists, max(LEAST_PROBED, int(np.ceil(PROBED * lists))))

    # One row for equal vectors. A query's own id may be among them, so one id more than asked for is kept.
    numbered = rows.withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    distinct = numbered.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = model.value[0]
        for batch in batches:
            if batch.num_rows:
                own = np.argmax(_unit(_matrix(batch.column(0))) @ centre.T, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], ["v", "ids", "list"])

    index = stored(distinct.mapInArrow(assigned, "v array<double>, ids array<long>, list int"), "vector-lists")
    sizes = index.groupBy("list").count()
    blocks = sizes.select("list", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))  # at most MOST_LISTS rows
    index = index.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))

    few = index.agg(F.sum(F.size("ids"))).first()[0] <= k + 1
    take = lists if few else probed

    def aimed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = model.value[0]
        for batch in batches:
            if batch.num_rows:
                near = np.argsort(-(_unit(_matrix(batch.column(1))) @ centre.T), axis=1, kind="stable")[:, :take]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))], ["vec_id", "v", "lists"])

    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v").mapInArrow(aimed, "vec_id long, v array<double>, lists array<int>")
    queries = (
        queries.withColumn("turn", F.pmod(F.xxhash64("vec_id"), F.lit(16)).cast("int"))
        .select("vec_id", "v", "turn", F.explode("lists").alias("list")).join(F.broadcast(blocks), "list")
        .select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "turn", "vec_id", "v")
    )
    # A query meets each block of its lists; a block is copied to those turns (at most 16) that have queries for it.
    turns = queries.select(F.col("list").alias("l"), F.col("block").alias("b"), F.col("turn").alias("t")).distinct()
    own = (F.col("list") == F.col("l")) & (F.col("block") == F.col("b"))
    candidates = index.join(turns, own).select("l", "b", "t", "v", "ids")

    def scanned(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scan(left, right, model.value[1], k)

    found = queries.groupBy("list", "block", "turn").cogroup(candidates.groupBy("l", "b", "t")).applyInArrow(
        scanned, "query_id long, vec_id long, score double"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cosines(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Summed row by row in one fixed way, so that equal vectors get equal scores wherever they lie."""
    dots = (rows * q).sum(axis=1)
    norms = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((q * q).sum())
    with np.errstate(all="ignore"):
        out = dots / norms
    odd = ~np.isfinite(out) | (norms < 1e-280)
    if odd.any():
        out[odd] = (_unit(rows[odd]) * _unit(q[None])).sum(axis=1)
    return out


def _scan(queries: pa.Table, rows: pa.Table, rotation: np.ndarray, k: int) -> pa.Table:
    out_query, out_id, out_score = [], [], []
    if queries.num_rows and rows.num_rows:
        original = _matrix(rows.column("v"))
        ids = rows.column("ids").to_pylist()
        turned = (_unit(original) @ rotation).astype(np.float32)
        d = turned.shape[1]
        columns = [np.ascontiguousarray(turned[:, a : a + COLUMN_BLOCK]) for a in range(0, d, COLUMN_BLOCK)]
        query = _matrix(queries.column("v"))
        aimed = (_unit(query) @ rotation).astype(np.float32)
        for own, vector, target in zip(queries.column("vec_id").to_pylist(), query, aimed):
            best = _one(target, vector, own, columns, original, ids, d, k)
            out_query += [own] * len(best)
            out_id += [i for _, i in best]
            out_score += [-s for s, _ in best]
    return pa.table({"query_id": pa.array(out_query, pa.int64()), "vec_id": pa.array(out_id, pa.int64()), "score": pa.array(out_score, pa.float64())})


def _one(target, vector, own, columns, original, ids, d, k) -> list[tuple[float, int]]:
    """(-score, id) of the block's nearest to one query, nearest first."""
    alive = np.arange(len(original))
    partial = ((columns[0] - target[: columns[0].shape[1]]) ** 2).sum(axis=1)
    # The bound: exact distances of those that look nearest after the first column block.
    first = np.argpartition(partial, min(4 * k, len(partial) - 1))[: 4 * k + 1]
    best: list[tuple[float, int]] = []

    def meet(some: np.ndarray) -> None:
        nonlocal best
        scores = _cosines(vector, original[some])
        best = sorted({*best, *((-s, i) for s, r in zip(scores.tolist(), some.tolist()) for i in ids[r] if i != own)})[:k]

    meet(first)
    used = columns[0].shape[1]
    for block in columns[1:]:
        if len(best) == k:
            bound = 2 + 2 * best[-1][0]
            keep = partial * (d / used) <= bound * (1 + EPSILON / np.sqrt(used)) ** 2 + 1e-5
            alive, partial = alive[keep], partial[keep]
        partial = partial + ((block[alive] - target[used : used + block.shape[1]]) ** 2).sum(axis=1)
        used += block.shape[1]
    if len(best) == k:
        alive = alive[partial <= 2 + 2 * best[-1][0] + 1e-5]
    meet(np.setdiff1d(alive, first, assume_unique=True))
    return best
