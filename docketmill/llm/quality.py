"""Quality scores by voting of the nearest labelled neighbours in a latent space.

Method: texts become counts of word shapes, hashed words and repetition marks, weighted by inverse document
frequency. A truncated singular value decomposition of a bounded sample of labelled rows gives the latent
space; the sample's vectors and labels are broadcast, every document's cosine with all of them is computed
as a blocked matrix product, and the NEIGHBOURS nearest vote with weights that rise with similarity.

The sample has at most SAMPLE rows, those with the smallest hash of their id, whatever the size of the input;
features have a fixed number of dimensions, so the broadcast is bounded.

Cases: null text counts as empty; texts without features, and all texts when there are no labels, get the
sample's share of label 1 (0.5 without labels); all sample rows that tie with the last neighbour vote, too; labels that are null or other than 0 and 1 are not learnt from; of several
labels of a row each counts; repeated rows give repeated rows; rows with a null doc_id are scored and not held out;
an empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin, keeps

SAMPLE, RANK, NEIGHBOURS, POWER = 4000, 48, 25, 8
SHAPES, WORDS, MARKS = 512, 1024, 24
DIM = SHAPES + WORDS + MARKS
THRESHOLD = 0.3
#: Distinct words whose features a worker keeps.
KNOWN = 100_000


class Model(NamedTuple):
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def shape(word: str) -> str:
    """Kinds of characters with runs taken together, letters by case and digits as one kind each."""
    out = []
    for c in word:
        k = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


class _Features(dict):
    """Word to shape number * 2^32 + word hash."""

    def __missing__(self, word: str) -> int:
        x = self[word] = (zlib.crc32(shape(word).encode("utf-8", "surrogatepass")) % SHAPES << 32) | zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
        return x


_known = _Features()
keeps("quality", _known.clear)


def counts(texts: list[str]) -> np.ndarray:
    """Raw feature rows: logarithmic counts of shapes and words, and marks of repetition."""
    if len(_known) > KNOWN:
        _known.clear()
    out = np.zeros((len(texts), DIM), np.float32)
    for i, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        x = np.fromiter(map(_known.__getitem__, words), np.int64, len(words))
        n = len(x)
        out[i, :SHAPES] = np.bincount(x >> 32, minlength=SHAPES) / n
        out[i, SHAPES : SHAPES + WORDS] = np.bincount((x & 0xFFFFFFFF) % WORDS, minlength=WORDS) / n
        same = (x[1:] == x[:-1]).mean() if n > 1 else 0.0
        out[i, SHAPES + WORDS + min(7, int(same * 16))] = 1
        # Distinct words in stretches of 64, the last one as long as it is.
        fresh = 0
        for part in (x[: n // 64 * 64].reshape(-1, 64), x[n // 64 * 64 :][None, :]):
            if part.size:
                ordered = np.sort(part, axis=1)
                fresh += (ordered[:, 1:] != ordered[:, :-1]).sum() + len(part)
        fresh /= n
        out[i, SHAPES + WORDS + 8 + min(15, int(fresh * 16))] = 1
    return out


def weighted(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows whose three parts have unit length each (half for words): no part drowns the others."""
    x = np.sqrt(raw) * idf
    at = 0
    for size, weight in ((SHAPES, 1.0), (WORDS, 0.5), (MARKS, 1.0)):
        part = x[:, at : at + size]
        norm = np.linalg.norm(part, axis=1, keepdims=True)
        x[:, at : at + size] = weight * part / np.where(norm > 0, norm, 1)
        at += size
    return x


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def fit(raw: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Model:
    """Latent axes by subspace iteration from a fixed start."""
    if not len(labels):
        return Model(np.ones(DIM, np.float32), np.zeros((DIM, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5)
    idf = (np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))) + 1).astype(np.float32)
    x = weighted(raw, idf)
    axes = np.linalg.qr(np.random.default_rng(7).standard_normal((DIM, min(rank + 8, DIM))))[0]
    for _ in range(8):
        axes = np.linalg.qr(x.T @ (x @ axes))[0]
    axes = axes[:, :rank].astype(np.float32)
    return Model(idf, axes, unit(x @ axes), labels.astype(np.float32), float(labels.mean()))


def vote(model: Model, raw: np.ndarray, neighbours: int = NEIGHBOURS, block: int = 1024) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest neighbours, all that tie with the last of them included."""
    if not len(model.labels) or not len(raw):
        return np.full(len(raw), model.prior)
    if len(raw) > block:
        return np.concatenate([vote(model, raw[at : at + block], neighbours, block) for at in range(0, len(raw), block)])
    cos = unit(weighted(raw, model.idf) @ model.axes) @ model.vectors.T
    k = min(neighbours, cos.shape[1])
    last = np.partition(cos, cos.shape[1] - k, axis=1)[:, cos.shape[1] - k]
    row, near = np.nonzero(cos >= last[:, None])
    weight = np.clip(cos[row, near].astype(np.float64), 0, 1) ** POWER
    total = np.bincount(row, weight, len(raw))
    score = np.bincount(row, weight * model.labels[near], len(raw)) / np.where(total > 0, total, 1)
    return np.where((total > 0) & (raw.sum(axis=1) > 0), np.clip(score, 0, 1), model.prior)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled rows that are not held out."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1) AND doc_id IS NOT NULL")
    known = known.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(known), "doc_id")  # at most `sample` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        for batch in batches:
            raw = counts(batch.column(1).to_pylist())
            sparse = [(np.flatnonzero(r).astype("<i4").tobytes(), r[r != 0].astype("<f4").tobytes()) for r in raw]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "y": batch.column(2), "i": pa.array([a for a, _ in sparse], pa.binary()), "v": pa.array([b for _, b in sparse], pa.binary())})

    got = rows.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y int, i binary, v binary").orderBy("doc_id", "y", "i").limit(sample).collect()
    raw = np.zeros((len(got), DIM), np.float32)
    for n, r in enumerate(got):
        raw[n, np.frombuffer(r.i, "<i4")] = np.frombuffer(r.v, "<f4")
    return fit(raw, np.array([r.y for r in got], np.float32))


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with held_out, score and predicted in the place of its other columns but the id."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        for batch in batches:
            score = vote(sent.value, counts(batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(1), "score": pa.array(score, pa.float64()), "predicted": pa.array((score >= threshold).astype(np.int32))})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col).cast("long")).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least the threshold, unchanged.

    Null and empty texts score the model's prior; repeated rows stay or go together; an empty table stays empty;
    other columns take no part, whatever their names."""
    schema, sent = docs.schema, docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array(vote(sent.value, counts([t or "" for t in texts])) >= threshold))

    return docs.mapInArrow(run, schema)
