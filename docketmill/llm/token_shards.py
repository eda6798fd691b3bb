"""Token ids in binary shards with keyed access.

Method: documents are dealt to shards by ranges of doc_id and tokenized; each shard file holds the raw
ids of its documents in ascending doc_id order and a minimal perfect hash index: cascaded bit arrays
with rank (the key's bit, counted over the bits before it, is its slot), and per slot a stored
fingerprint, the offset and the length of the document's ids. A lookup reads one slot; a key that is
not in the shard fails the fingerprint but for a chance of 2^-32.

File: magic, ids (uint16 where the vocabulary allows it, else uint32), index sections, a JSON footer with
the place of every section, the footer's length, magic. Files are written under a name of their own
and then renamed, so a task that runs again replaces a whole file by an equal one.

Cases: null text counts as empty and gives the end id alone; a null doc_id sorts first; rows with one
doc_id follow one another in the order of their ids and have keys (doc_id, 0), (doc_id, 1), ...; an empty
table gives no shard and an empty result; extra columns are left alone.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import byte_bpe, ids_of, vocabulary_size
from .common import durable, own_dir

MAGIC = b"DKMILL01"
GAMMA, LEVELS = 2.0, 24
#: Documents of a shard, and shards of a table at most (164 million documents before shards grow).
DOCS_PER_SHARD, MOST_SHARDS = 8192, 20_000


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers) of x and salt."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def key_hash(ids: np.ndarray, nulls: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """The hash of a document key: its id, or that it has none, and its number among the rows of that id."""
    with np.errstate(over="ignore"):
        return mix(np.where(nulls, 0, ids).astype(np.int64).view(np.uint64), 1) ^ (mix(nth.astype(np.uint64) * np.uint64(2) + nulls.astype(np.uint64), 2) * np.uint64(0xD6E8FEB86659FD93))


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit hashes: level sizes, bit words, ranks, and what is left over."""

    def __init__(self, sizes: list[int], words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = sizes, words, np.sort(rest)
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words, left = [], [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = -(-max(64, int(GAMMA * len(left))) // 64) * 64
            at = (mix(left, 10 + level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, "<u8"), left)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for what is surely absent."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = self.base[level] + (mix(keys[open_], 10 + level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = (self.ranks[at >> 6] + below)[hit]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.ranks[-1] + at[hit]
        return out


def numbered(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """The number of each row among the rows of its id, which stand together."""
    n = np.arange(len(ids))
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (nulls[1:] != nulls[:-1])
    return n - np.maximum.accumulate(np.where(fresh, n, 0))


class ShardWriter:
    """Streams the ids of one shard to its file; only the index is held in memory."""

    def __init__(self, store: fs.FileSystem, path: str, width: int):
        self.store, self.path, self.width = store, path, width
        self.temp = f"{path}.{uuid.uuid4().hex}.part"
        self.out = store.open_output_stream(self.temp)
        self.out.write(MAGIC)
        self.ids: list[int | None] = []
        self.sizes: list[int] = []

    def add(self, doc_id: int | None, data: bytes) -> None:
        self.out.write(data)
        self.ids.append(doc_id)
        self.sizes.append(len(data) // self.width)

    def close(self) -> tuple[int, int]:
        nulls = np.array([x is None for x in self.ids], bool)
        ids = np.array([x or 0 for x in self.ids], np.int64)
        sizes = np.array(self.sizes, np.int64)
        starts = np.cumsum(sizes) - sizes
        keys = key_hash(ids, nulls, numbered(ids, nulls))
        index = PerfectHash.build(keys)
        slots = index.slots(keys)
        prints, offsets, lengths = np.zeros(len(ids), "<u4"), np.zeros(len(ids), "<i8"), np.zeros(len(ids), "<i8")
        prints[slots] = mix(keys, 99) >> np.uint64(32)
        offsets[slots], lengths[slots] = starts, sizes
        footer, at = {"width": self.width, "levels": index.sizes, "n_ids": int(sizes.sum())}, len(MAGIC) + int(sizes.sum()) * self.width
        for name, part in (("ids", ids.astype("<i8")), ("nulls", nulls.astype("u1")), ("words", index.words), ("rest", index.rest.astype("<u8")), ("prints", prints), ("offsets", offsets), ("lengths", lengths)):
            self.out.write(part.tobytes())
            footer[name] = [at, len(part), part.dtype.str]
            at += part.nbytes
        tail = json.dumps(footer).encode()
        self.out.write(tail + struct.pack("<Q", len(tail)) + MAGIC)
        self.out.close()
        self.store.move(self.temp, self.path)
        return len(ids), int(sizes.sum())


class ShardReader:
    """Keyed access to one shard."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        end = self.file.size()
        size, magic = struct.unpack("<Q8s", self.file.read_at(16, end - 16))
        if magic != MAGIC:
            raise ValueError(f"not a shard: {path}")
        self.footer = json.loads(self.file.read_at(size, end - 16 - size))
        self.width = self.footer["width"]
        part = {k: np.frombuffer(self.file.read_at(n * np.dtype(t).itemsize, at), t) for k, (at, n, t) in ((k, self.footer[k]) for k in ("ids", "nulls", "words", "rest", "prints", "offsets", "lengths"))}
        self.ids, self.nulls = part["ids"], part["nulls"].astype(bool)
        self.index = PerfectHash(self.footer["levels"], part["words"], part["rest"])
        self.prints, self.offsets, self.lengths = part["prints"], part["offsets"], part["lengths"]

    def locate(self, ids: np.ndarray, nulls: np.ndarray | None = None, nth: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Offset and length in ids for each key; -1 and 0 for keys that the shard lacks."""
        nulls = np.zeros(len(ids), bool) if nulls is None else nulls
        keys = key_hash(ids, nulls, np.zeros(len(ids), np.int64) if nth is None else nth)
        slots = self.index.slots(keys)
        found = slots >= 0
        at = np.where(found, slots, 0)
        if len(self.prints):
            found &= self.prints[at] == (mix(keys, 99) >> np.uint64(32)).astype(np.uint32)
        else:
            found[:] = False
        return np.where(found, self.offsets[at] if len(self.prints) else -1, -1), np.where(found, self.lengths[at] if len(self.prints) else 0, 0)

    def read(self, offset: int, length: int) -> np.ndarray:
        data = self.file.read_at(length * self.width, len(MAGIC) + offset * self.width)
        return np.frombuffer(data, "<u2" if self.width == 2 else "<u4")

    def get(self, doc_id: int) -> np.ndarray | None:
        offset, length = self.locate(np.array([doc_id], np.int64))
        return None if offset[0] < 0 else self.read(int(offset[0]), int(length[0]))


def shard_bounds(docs: DataFrame, id_col: str, docs_per_shard: int, most: int = MOST_SHARDS) -> list[int]:
    """First doc_id of every shard but the first, found from doc_id alone.

    At most `most` shards, as the bounds go to the driver: beyond docs_per_shard * most documents shards grow."""
    n = docs.agg(F.count("*")).first()[0]
    shards = min(most, -(-n // docs_per_shard))
    if shards < 2:
        return []
    at = [k / shards for k in range(1, shards)]
    found = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), at, 20 * shards)).first()[0]
    return sorted(set(found or []))


def with_end(ids: pa.Array, end_id: int, width: int) -> pa.Array:
    """A column of uint32 ids as ids of the width, with the end id behind each row's."""
    bounds = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1] // 4
    flat = np.frombuffer(ids.buffers()[2] or b"", "<u4", int(bounds[-1]))[bounds[0] :]
    sizes = np.diff(bounds)
    if width == 2 and len(flat) and flat.max() > 0xFFFF:
        raise ValueError("an id does not fit 16 bits")
    out = np.full(len(flat) + len(ids), end_id, "<u2" if width == 2 else "<u4")
    out[np.arange(len(flat)) + np.repeat(np.arange(len(ids)), sizes)] = flat
    ends = np.concatenate([[0], np.cumsum(sizes + 1)]) * width
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary())


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, vocab: int | None = None, id_col: str = "doc_id", text_col: str = "text", docs_per_shard: int = DOCS_PER_SHARD, most_shards: int = MOST_SHARDS) -> DataFrame:
    """Write the shards; returns their manifest: shard, path, n_docs, n_ids, start (ids in the shards before).

    vocab: the number of ids, the tokenizer's where it is not given; ids take 16 bits where all of them fit."""
    bounds = shard_bounds(docs, id_col, docs_per_shard, most_shards)
    width = 2 if max(vocab or vocabulary_size(tokenizer), end_id + 1) <= 65_536 else 4

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cuts = byte_bpe(tokenizer), np.array(bounds, np.int64)
        for batch in batches:
            ids = batch.column(0)
            shard = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right"))
            yield pa.RecordBatch.from_pydict({"shard": pa.array(shard, pa.int32()), "doc_id": ids, "ids": with_end(ids_of(table, batch.column(1)), end_id, width)})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        rows, writer, now = [], None, None
        for batch in batches:
            for shard, doc_id, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if shard != now:
                    if writer:
                        rows.append((now, *writer.close()))
                    now, writer = shard, ShardWriter(store, f"{root}/shard-{shard:08d}.dkm", width)
                writer.add(doc_id, data)
        if writer:
            rows.append((now, *writer.close()))
        yield pa.RecordBatch.from_pydict({"shard": pa.array([r[0] for r in rows], pa.int32()), "n_docs": pa.array([r[1] for r in rows], pa.int64()), "n_ids": pa.array([r[2] for r in rows], pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(tokenize, "shard int, doc_id long, ids binary")
    rows = rows.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
    manifest = durable(rows.mapInArrow(write, "shard int, n_docs long, n_ids long"))
    # One row for each shard, at most a few ten thousand.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumns({"start": F.coalesce(F.sum("n_ids").over(before), F.lit(0)), "path": F.format_string(f"{folder}/shard-%08d.dkm", F.col("shard"))})


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, from the files by key: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = fs.FileSystem.from_uri(path)
                shard = ShardReader(store, name)
                offsets, lengths = shard.locate(shard.ids, shard.nulls, numbered(shard.ids, shard.nulls))
                if (offsets < 0).any():
                    raise ValueError(f"the index of {path} lacks a document of its own")
                crc = [zlib.crc32(shard.read(o, n).astype("<u4").tobytes()) for o, n in zip(offsets.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(shard.ids, pa.int64(), mask=shard.nulls), "start": pa.array(offsets + base, pa.int64()), "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    rows = durable(manifest.select("path", "start", "shard"))
    n = max(1, rows.count())
    return rows.repartitionById(min(n, 20_000), F.col("shard")).select("path", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark) -> str:
    return f"{own_dir(spark)}/shards-{uuid.uuid4().hex}"
