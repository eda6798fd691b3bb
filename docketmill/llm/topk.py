"""Exact top-k search by distributed histogram selection.

Method: every pass scores all candidates against a block of queries as one matrix product and counts the
scores in each query's current interval; the counts are summed over all tasks, the bin that holds the kth
highest score becomes the next interval, until a bin is one integer wide. The last pass keeps what is above
the kth score, and of what equals it the smallest ids, which a window orders.

Vectors become integers floor(scale * x). Queries are taken in blocks of about BLOCK rows, so the broadcast
and a task's histograms are bounded; each block's result is written before the next block begins, and the
result is read from one folder, so its plan is the same for any number of queries. A task sends for each query
only the highest bins that hold k of its own scores, since the kth score of all is at least that of a part.

Cases: vectors that are null or hold null or non-finite components take no part, neither do empty ones;
vectors of other lengths than a query's are no candidates of it; rows with a query's own id are no
candidates; repeated rows are candidates each, but a query id asks once: of several vectors with it the smallest,
by their components in order; equal scores go to the smaller id; with fewer than k
candidates all are returned; an empty table gives an empty result; extra columns are left alone. Scores
are computed in doubles where they are provably exact and in 64-bit integers beyond; a possible overflow of
those raises.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import own_dir

BLOCK, BINS = 4096, 1024


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id, v (array of whole doubles); only vectors that take part."""
    vec = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    raw = F.col(vec_col)
    fine = raw.isNotNull() & (F.size(raw) > 0) & F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.filter(fine & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vec.alias("v"))


def _matrix(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, rows) of a batch, for each vector length in it."""
    ids, v = batch.column(0).to_numpy(), batch.column(1)
    sizes = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy()
    if len(sizes) and (sizes == sizes[0]).all():
        yield ids, flat.reshape(len(ids), -1)
        return
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        yield ids[at], flat[starts[at][:, None] + np.arange(d)]


def _scores(queries: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    return (queries @ rows.T).astype(np.int64) if exact else queries.astype(np.int64) @ rows.T.astype(np.int64)


def top_k(df: DataFrame, every: int = 50, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK, bins: int = BINS) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by `every`."""
    spark = df.sparkSession
    rows = integer_vectors(df, id_col, vec_col, scale)
    asked = rows.filter(F.pmod(F.col("id"), F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v"))
    largest = rows.agg(F.max(F.expr("array_max(transform(v, x -> abs(x)))"))).first()[0]
    blocks = -(-asked.count() // block)
    schema = "query_id long, rank int, vec_id long, score long"
    if not blocks:
        return spark.createDataFrame([], schema)
    path = f"{own_dir(spark)}/{uuid.uuid4().hex}"
    for b in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()  # about `block` rows, one for each id
        part = _block(spark, rows, mine, largest, k, bins)
        if blocks == 1:
            return part
        if mine:
            part.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _block(spark, rows: DataFrame, mine: list, largest: float, k: int, bins: int) -> DataFrame:
    sizes: dict[int, list[int]] = {}
    for i, r in enumerate(mine):
        sizes.setdefault(len(r.v), []).append(i)
    ids = np.array([r.id for r in mine], np.int64)
    stacks = {d: np.array([mine[i].v for i in at]) for d, at in sizes.items()}
    at_of = {d: np.array(at) for d, at in sizes.items()}
    bound = np.array([int(sum(map(abs, r.v))) * int(largest) for r in mine], dtype=object)
    if len(bound) and max(bound) >= 2**62:
        raise OverflowError("scores may not fit a long")
    exact = not len(bound) or max(bound) < 2**53
    low = np.array([-x for x in bound], np.int64)
    width = np.array([-(-(2 * int(x) + 1) // bins) for x in bound], np.int64)
    high = low + bins * width
    above = np.zeros(len(mine), np.int64)
    found = np.ones(len(mine), bool)
    sent = spark.sparkContext.broadcast((ids, stacks, at_of))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(query numbers, candidate ids, scores, mask of true candidates) blockwise."""
        own, stack, where = sent.value
        for batch in batches:
            for names, vectors in _matrix(batch):
                at = where.get(vectors.shape[1])
                if at is not None:
                    yield at, names, _scores(stack[vectors.shape[1]], vectors, exact), own[at][:, None] != names[None, :]

    while True:
        lo, hi, wide = low.copy(), high.copy(), width.copy()

        def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros((len(lo), bins), np.int64)
            for at, _, score, ok in scored(batches):
                bin_ = (score - lo[at][:, None]) // wide[at][:, None]
                ok &= (score >= lo[at][:, None]) & (score < hi[at][:, None])
                flat = (np.arange(len(at))[:, None] * bins + bin_)[ok]
                held[at] += np.bincount(flat, minlength=len(at) * bins).reshape(len(at), bins)
            # Only the highest bins that hold k of this task's scores.
            over = np.cumsum(held[:, ::-1], axis=1)[:, ::-1] - held
            q, bin_ = np.nonzero((held > 0) & (over < k))
            yield pa.RecordBatch.from_pydict({"q": pa.array(q, pa.int32()), "bin": pa.array(bin_, pa.int32()), "n": pa.array(held[q, bin_], pa.int64())})

        hist = rows.mapInArrow(counts, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        over = F.coalesce(F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        need = spark.createDataFrame([(i, int(k - a)) for i, a in enumerate(above)], "q int, need long") if len(mine) else None
        pick = hist.withColumn("over", over).join(F.broadcast(need), "q").filter("over < need AND over + n >= need")
        hit = pick.select("q", "bin", "over").collect()  # at most one row for each query of the block
        seen = np.zeros(len(mine), bool)
        for q, bin_, more in hit:
            seen[q] = True
            low[q] += bin_ * width[q]
            high[q] = min(high[q], low[q] + width[q])
            above[q] += more
        found &= seen
        if not (found & (width > 1)).any():
            break
        width = np.where(found, -(-width // bins), width)
    kth = np.where(found, low, np.iinfo(np.int64).min)
    room = np.where(found, k - above, 0)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value[0]
        ties: dict[int, list[int]] = {}
        for at, names, score, ok in scored(batches):
            q, c = np.nonzero(ok & (score > kth[at][:, None]))
            yield pa.RecordBatch.from_pydict({"query_id": pa.array(own[at[q]], pa.int64()), "vec_id": pa.array(names[c], pa.int64()), "score": pa.array(score[q, c], pa.int64())})
            q, c = np.nonzero(ok & (score == kth[at][:, None]) & found[at][:, None])
            for x in np.unique(q).tolist():
                i = int(at[x])
                ties[i] = sorted([*ties.get(i, []), *names[c[q == x]].tolist()])[: int(room[i])]
        flat = [(int(own[i]), x, int(kth[i])) for i, xs in ties.items() for x in xs]
        yield pa.RecordBatch.from_pydict({name: pa.array([f[j] for f in flat], pa.int64()) for j, name in enumerate(("query_id", "vec_id", "score"))})

    kept = rows.mapInArrow(keep, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return kept.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
