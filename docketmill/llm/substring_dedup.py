"""Removal of word windows that an earlier document has, by prefix-partitioned suffix trees.

Method: every window of `window` words has an anchor, the place of the least of the hashes of its prefixes of a
third of its words (a choice that depends on the window's words alone, so equal windows have equal anchors).
Prefixes at anchors of one document only have no node with leaves of two documents and are dropped; the others
split the suffixes into groups. In a task the suffixes of a group are sorted by their words, once from
the anchor on and once, read backwards, before it; the lengths of neighbours' common prefixes are the depths
of the internal nodes of the two trees. A node of depth r after the anchor and one of depth l before it, with r + l
at least the window, hold a maximal repeat: of each of its windows the smallest document keeps its words.

A prefix with more than GROUP suffixes does not go to one task. It is lengthened to whole windows, which
have one leaf each: their smallest and largest documents are aggregated where the rows are, before any shuffle,
and those in two documents are broadcast where a count finds at most MOST of them, else joined window by window.

Groups are compared by their words, lengthened prefixes by 128-bit hashes of theirs.

Cases: null text counts as empty; documents shorter than a window lose nothing; repeated rows with one
doc_id do not remove each other's words (their doc_id is not smaller); rows with a null doc_id neither lose words
nor make others lose any; an empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, keeps, sorted_groups, written

WINDOW = 50
#: Suffixes that a prefix may have before it is lengthened.
GROUP = 4096
#: Windows of lengthened prefixes that are broadcast at most.
MOST = 1_000_000
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)
#: Distinct words whose hashes a worker keeps.
WORDS = 500_000


class _Words(dict):
    """Word to a 64-bit hash."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        import xxhash

        x = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return x


_known, _second = _Words(0x5EED), _Words(0xD1CE)
#: Whose tasks know words; the others of this module free them, as they ask for none.
KNOW, COMPARE = "substring_dedup", "substring_dedup, compared"
keeps(KNOW, _known.clear)


def split_words(text: str) -> list[bytes]:
    """Stretches without space and tab to carriage return: what bytes.split() cuts at."""
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes], known: _Words = _known) -> np.ndarray:
    if len(known) > WORDS:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each `size` consecutive words: sum of h[i+j] * BASE^j modulo 2^64."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(BASE, n), dtype=np.uint64)])
    return (sums[size:] - sums[: n - size + 1]) * _powers(BASE_INVERSE, n - size + 1)


def sliding_argmin(x: np.ndarray, size: int) -> np.ndarray:
    """The place of the first least of each `size` consecutive numbers, by doubling."""
    at, reach = np.arange(len(x)), 1
    while reach < size:
        step = min(reach, size - reach)
        left, right = at[:-step], at[step:]
        at = np.where(x[left] <= x[right], left, right)
        reach += step
    return at


def prefix_words(window: int) -> int:
    return max(1, window // 3)


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Every window's anchor; and the prefix hashes at all places."""
    short = prefix_words(window)
    prefixes = rolling(hashes, short)
    if len(hashes) < window:
        return np.zeros(0, np.int64), prefixes
    return sliding_argmin(prefixes ^ (prefixes >> np.uint64(29)), window - short + 1), prefixes


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """prefix, doc_id, row, pos: the distinct anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(KNOW)
        for batch in batches:
            prefix, at, sizes = [], [], []
            for text in batch.column(2).to_pylist():
                where, hashes = anchors(word_hashes(split_words(text)), window)
                where = where[np.diff(where, prepend=-1) != 0]
                prefix.append(hashes[where])
                at.append(where)
                sizes.append(len(where))
            take = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            flat = np.concatenate(prefix).astype(np.uint64).view(np.int64) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict({"prefix": pa.array(flat), "doc_id": batch.column(0).take(take), "row": batch.column(1).take(take), "pos": pa.array(np.concatenate(at) if at else [], pa.int32())})

    return docs.filter("doc_id IS NOT NULL").mapInArrow(run, "prefix long, doc_id long, row int, pos int")


SUFFIXES = "prefix long, hot boolean, doc_id long, row int, first int, rel int, words binary, digests binary"


def _suffixes(held: DataFrame, window: int) -> DataFrame:
    """For each shared anchor: the first of its windows, the anchor's place in it, and the words from the first
    window's start to the last one's end; of lengthened prefixes two hashes of each window instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(KNOW)
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        names = [c.split()[0] for c in SUFFIXES.split(", ")]
        for batch in batches:
            out: list[list] = [[] for _ in types]
            many = 0
            for doc_id, row, text, spots in zip(*(batch.column(k).to_pylist() for k in range(4))):
                words = split_words(text)
                hashes = word_hashes(words)
                where, prefixes = anchors(hashes, window)
                marks = {s["pos"]: s["hot"] for s in spots}
                starts = np.flatnonzero(np.diff(where, prepend=-1))
                ends = np.append(starts[1:], len(where))
                digests = None
                if any(marks.values()):
                    second = rolling(word_hashes(words, _second), window)
                    digests = np.column_stack([rolling(hashes, window), second]).astype("<u8")
                named = prefixes.view(np.int64)
                for a, b, pos in zip(starts.tolist(), ends.tolist(), where[starts].tolist()):
                    hot = marks.get(pos)
                    if hot is None:
                        continue
                    span = None if hot else b" ".join(words[a : b + window - 1])
                    for col, v in zip(out, (int(named[pos]), hot, doc_id, row, a, pos - a, span, digests[a:b].tobytes() if hot else None)):
                        col.append(v)
                    many += 16 * (b - a) if hot else len(span)
                if many > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)
                    out, many = [[] for _ in types], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return held.mapInArrow(run, SUFFIXES)


def _ranges(doc: np.ndarray, row: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Runs of consecutive starts of one document, given in order."""
    if not len(doc):
        cut = np.zeros(0, np.int64)
    else:
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)
        cut = np.flatnonzero(new)
    last = np.append(cut[1:], len(doc)) - 1 if len(cut) else cut
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc[cut], pa.int64()), "row": pa.array(row[cut], pa.int32()), "s": pa.array(start[cut], pa.int32()), "e": pa.array(start[last], pa.int32())})


class SuffixTree:
    """Sequences of word numbers (a matrix, 0 behind their ends) in order, with the depths at which neighbours part."""

    def __init__(self, rows: np.ndarray):
        self.n, width = rows.shape
        keys = np.ascontiguousarray(rows, ">u4").view(f"S{4 * width}").ravel() if width else np.zeros(self.n, "S1")
        self.order = np.argsort(keys, kind="stable")
        differ = rows[self.order[1:]] != rows[self.order[:-1]]
        self.depth = np.where(differ.any(axis=1), differ.argmax(axis=1), width) if width else np.zeros(max(0, self.n - 1), np.int64)

    def nodes(self, depth: int) -> np.ndarray:
        """For each sequence the number of the node at the depth that it goes through."""
        out = np.zeros(self.n, np.int64)
        out[self.order[1:]] = np.cumsum(self.depth < depth)
        return out


def least_documents(words: pa.Array, rel: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of its leaf, and for each leaf and window the smallest document with that window.

    Column j is the window that starts j words before the anchor; leaves without it have the largest number there."""
    short = prefix_words(window)
    spans = words.dictionary_encode()
    leaf, number = np.unique(spans.indices.to_numpy().astype(np.int64) * window + rel, return_inverse=True)
    cut = pc.split_pattern(spans.dictionary, b" ")
    flat, offsets = cut.flatten().dictionary_encode().indices.to_numpy() + 1, cut.offsets.to_numpy().astype(np.int64)
    flat = np.append(flat, 0)
    span, rel = leaf // window, leaf % window
    anchor, begin, end = offsets[span] + rel, offsets[span], offsets[span + 1]
    forth, back = anchor[:, None] + np.arange(window), anchor[:, None] - 1 - np.arange(window - short)
    after = SuffixTree(flat[np.where(forth < end[:, None], forth, len(flat) - 1)])
    before = SuffixTree(flat[np.where(back >= begin[:, None], back, len(flat) - 1)])
    lowest = np.full(len(leaf), np.iinfo(np.int64).max)
    np.minimum.at(lowest, number, doc)
    least = np.full((len(leaf), window - short + 1), np.iinfo(np.int64).max)
    first = rel - (end - begin - window)  # the windows that this anchor has start `first` to `rel` words before it
    for j in range(window - short + 1):
        here = np.flatnonzero((j <= rel) & (j >= first))
        if len(here):
            node = after.nodes(window - j)[here] * len(leaf) + before.nodes(j)[here]
            order = np.argsort(node, kind="stable")
            node, here = node[order], here[order]
            fresh = np.flatnonzero(np.diff(node, prepend=-1))
            low = np.minimum.reduceat(lowest[here], fresh)
            least[here, j] = np.repeat(low, np.diff(np.append(fresh, len(here))))
    return number, least


def _subtrees(window: int):
    """The repeats below each prefix: windows that equal one of a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(COMPARE)
        for part in sorted_groups(batches, ["prefix"]):
            doc, row, first, rel = (part.column(k).to_numpy().astype(np.int64) for k in ("doc_id", "row", "first", "rel"))
            leaf, least = least_documents(part.column("words").combine_chunks(), rel, doc, window)
            at, j = np.nonzero(least[leaf] < doc[:, None])
            doc, row, start = doc[at], row[at], first[at] + rel[at] - j
            order = np.lexsort((start, row, doc))
            yield _ranges(doc[order], row[order], start[order])

    return run


def _windows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of rows of lengthened prefixes: row numbers, places in the row, two hashes."""
    data = batch.column("digests").to_pylist()
    sizes = np.array([len(x) // 16 for x in data], np.int64)
    at = np.repeat(np.arange(len(data)), sizes)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes), np.frombuffer(b"".join(data), "<u8").reshape(-1, 2).view(np.int64)


def _window_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the windows in a batch the smallest and largest document."""
    begin(COMPARE)
    for batch in batches:
        at, _, key = _windows_of(batch)
        doc = batch.column("doc_id").to_numpy()[at]
        order = np.lexsort((doc, key[:, 1], key[:, 0]))
        key, doc = key[order], doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]).any(axis=1)
        low = np.flatnonzero(new)
        high = np.append(low[1:], len(order)) - 1 if len(low) else low
        yield pa.RecordBatch.from_pydict({"w1": pa.array(key[low, 0]), "w2": pa.array(key[low, 1]), "a": pa.array(doc[low], pa.int64()), "b": pa.array(doc[high], pa.int64())})


def _against(sent):
    """Repeats among rows of lengthened prefixes, by the broadcast windows: sorted hashes and smallest documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(COMPARE)
        keys, least = sent.value
        for batch in batches:
            at, nth, key = _windows_of(batch)
            doc, row, first = (batch.column(k).to_numpy().astype(np.int64) for k in ("doc_id", "row", "first"))
            if len(keys):
                own = np.ascontiguousarray(key).view([("a", "<i8"), ("b", "<i8")]).ravel()
                place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = np.flatnonzero((keys[place] == own) & (least[place] < doc[at]))
            else:
                hit = np.zeros(0, np.int64)
            doc, row, start = doc[at[hit]], row[at[hit]], first[at[hit]] + nth[hit]
            order = np.lexsort((start, row, doc))
            yield _ranges(doc[order], row[order], start[order])

    return run


def _each_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of the rows."""
    begin(COMPARE)
    for batch in batches:
        at, nth, key = _windows_of(batch)
        doc, row, first = (batch.column(k).to_numpy()[at] for k in ("doc_id", "row", "first"))
        yield pa.RecordBatch.from_pydict({"w1": pa.array(key[:, 0]), "w2": pa.array(key[:, 1]), "doc_id": pa.array(doc, pa.int64()), "row": pa.array(row, pa.int32()), "s": pa.array(first + nth, pa.int32())})


def repeated_ranges(docs: DataFrame, window: int = WINDOW, group: int = GROUP, most: int = MOST) -> DataFrame:
    """doc_id, row, s, e: starts s to e of windows that also start in a smaller document. docs: doc_id, row, text."""
    ranges = "doc_id long, row int, s int, e int"
    found = written(_anchors(docs, window))
    # Written before the join, whose sides Spark can then split where a prefix is hot.
    shared = written(found.df.groupBy("prefix").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).filter("a < b").select("prefix", (F.col("n") > group).alias("hot")))
    spots = found.df.join(shared.df, "prefix").groupBy("doc_id", "row").agg(F.collect_list(F.struct("pos", "hot")).alias("spots"))
    spots = written(spots)
    found.drop()
    suffixes = written(_suffixes(docs.join(spots.df, ["doc_id", "row"]).select("doc_id", "row", "text", "spots"), window))
    spots.drop()
    few = suffixes.df.filter("NOT hot").select("prefix", "doc_id", "row", "first", "rel", "words")
    out = few.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_subtrees(window), ranges)
    hot = suffixes.df.filter("hot").select("doc_id", "row", "first", "digests")
    ends = hot.mapInArrow(_window_ends, "w1 long, w2 long, a long, b long").groupBy("w1", "w2").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    ends = written(ends.filter("a < b").select("w1", "w2", "a")).df
    if ends.count() <= most:
        known = ends.orderBy("w1", "w2").toArrow()
        keys = np.column_stack([known.column(k).to_numpy() for k in ("w1", "w2")]).astype("<i8")
        sent = docs.sparkSession.sparkContext.broadcast((np.ascontiguousarray(keys).view([("a", "<i8"), ("b", "<i8")]).ravel(), known.column("a").to_numpy()))
        return out.unionByName(hot.mapInArrow(_against(sent), ranges))
    single = hot.mapInArrow(_each_window, "w1 long, w2 long, doc_id long, row int, s int")
    return out.unionByName(single.join(ends, ["w1", "w2"]).filter("a < doc_id").select("doc_id", "row", "s", F.col("s").alias("e")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256; with texts also kept, the words that stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.hash(text).alias("row"), text.alias("text"))
    found = repeated_ranges(rows, window).groupBy("doc_id", "row").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(COMPARE)
        for batch in batches:
            n, removed, kept = [], [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = split_words(text)
                edge = np.zeros(len(words) + 1, np.int64)
                for r in ranges or ():
                    edge[r["s"]] += 1
                    edge[r["e"] + window] -= 1
                stay = np.cumsum(edge[:-1]) == 0
                left = words if stay.all() else [words[i] for i in np.flatnonzero(stay).tolist()]
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            cols = {"doc_id": batch.column(0), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])}
            yield pa.RecordBatch.from_pydict(cols | ({"kept": pa.array([k.decode() for k in kept])} if texts else {}))

    joined = rows.join(found, ["doc_id", "row"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)
