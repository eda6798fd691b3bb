"""SentencePiece encoding and decoding over a table of distinct chunks.

Method: the pieces of the model have the white-space marker only at their start, so no piece crosses
from one marked word into the next; every distinct marked word is segmented (and decoded) once, and
the ids are joined back in the order of the words. Texts with runs of spaces, or words that end in a
literal marker, are encoded whole, which gives the same ids.

Cases: null text counts as empty; an empty text has the begin and end ids alone and decodes to an
empty text; repeated rows give repeated rows; an empty table gives an empty result; extra columns are
left alone.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import _pieces, joined, pieces


def encode_texts(texts: pa.Array, model: str) -> Iterator[tuple[bytes, bytes]]:
    """For each text its ids, the model's begin and end ids included, as little-endian uint32 bytes, and the decoded text."""
    table, sp = pieces(model), _pieces(model)
    first, last = (struct.pack("<I", i) if i >= 0 else b"" for i in (sp.bos_id(), sp.eos_id()))
    offsets, numbers, values = table.values(texts)
    ids = joined(offsets, numbers, [v and v[0] for v in values])
    back = joined(offsets, numbers, [v and v[1] for v in values])
    odd = iter(texts.filter(pc.is_null(ids)).to_pylist())
    for own, text in zip(ids.to_pylist(), back.to_pylist()):
        if own is None:
            text = next(odd)
            own, text = table.whole(text) if text else (b"", b"")
        else:
            text = text[1:]  # decoding drops the one space that encoding puts in front
        yield first + own + last, text


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", payload: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256; with payload also ids (binary) and decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(encode_texts(batch.column(1), model))
            cols = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(i) // 4 for i, _ in out], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i, _ in out], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for _, t in out], pa.string()),
            }
            if payload:
                cols |= {"ids": pa.array([i for i, _ in out], pa.binary()), "decoded": pa.array([t.decode() for _, t in out], pa.string())}
            yield pa.RecordBatch.from_pydict(cols)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * payload)
