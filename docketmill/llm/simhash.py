"""SimHash near-duplicates by covering locality-sensitive hashing.

Method: fingerprints are 64-bit majorities of shingle hashes. Bit i of a fingerprint gets a nonzero vector
m(i) of radius + 1 bits; for each nonzero v the mask of v keeps the bits with <m(i), v> odd. Any `radius`
differing bits give as many linear equations for v, which leave a nonzero solution: in that table both
fingerprints have the same masked value. So every pair within the radius meets in one of the
2^(radius+1) - 1 tables, and pairs that meet are compared exactly.

Equal fingerprints count once. Table cells with more than CELL fingerprints are cut into blocks and their
pairs of blocks go to tasks of their own; a task sends a spanning set of the links it finds, not all pairs.

Cases: null text counts as empty; texts without words have fingerprint zero and are linked like any
other; fewer words than a shingle has give one shingle of all words; repeated rows give repeated rows;
rows with a null doc_id are linked but never name a component unless all of it has null ids; an empty
table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, durable, free_name, keeps, sorted_groups, written
from .components import components

#: Fingerprints that one task compares with one another.
CELL = 2048


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """The majority bits of the XXH64 hashes of the word shingles, A-Z lower-cased."""
    import xxhash

    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    shingles = map(b" ".join, zip(*(w[k:] for k in range(words)))) if len(w) >= words else [b" ".join(w)]
    n = max(1, len(w) - words + 1)
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64, n).astype("<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        ones += np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def masks(radius: int = 3) -> list[int]:
    """The 64-bit masks of the tables; bit i has the vector (i mod (2^(radius+1) - 1)) + 1."""
    tables = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(64) if ((i % tables + 1) & v).bit_count() % 2) for v in range(1, tables + 1)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("simhash")
        for batch in batches:
            fp = [_signed(fingerprint(t, words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": pa.array(fp, pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def near_links(fps: np.ndarray, group: np.ndarray, radius: int, also: np.ndarray | None = None, wide: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the pairs within the radius inside each run of equal group numbers.

    With a second signature in `also`, a pair must differ in at most `wide` bits of that one, too."""
    n = len(fps)
    label = np.arange(n)
    us, vs = [], []
    at = np.arange(n - 1) if n else np.zeros(0, np.int64)
    step = 1
    while len(at):
        at = at[at + step < n]
        at = at[group[at] == group[at + step]]
        a, b = at, at + step
        near = (label[a] != label[b]) & (np.bitwise_count(fps[a] ^ fps[b]) <= radius)
        if also is not None:
            near &= np.bitwise_count(also[a] ^ also[b]) <= wide
        a, b = a[near], b[near]
        if len(a):
            us.append(a)
            vs.append(b)
            while True:
                low = np.minimum(label[a], label[b])
                old = label.copy()
                np.minimum.at(label, label[a], low)
                np.minimum.at(label, label[b], low)
                np.minimum.at(label, a, low)
                np.minimum.at(label, b, low)
                label = label[label]
                if (label == old).all():
                    break
        step += 1
    none = np.zeros(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def fingerprint_links(fps: DataFrame, radius: int = 3, cell: int = CELL, name: str = "fp", also: str | None = None, wide: int = 64) -> DataFrame:
    """Links (u, v) between the names of fingerprints (column fp) that connect all pairs within the radius."""
    fps = fps.select("fp", F.col(name).alias("name"), F.col(also or name).alias("also"))
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks(radius))])
    cells = fps.select("fp", "name", "also", F.explode(tables).alias("c")).select("fp", "name", "also", "c.t", "c.key")
    sizes = cells.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = cells.join(sizes, ["t", "key"]).withColumn("nb", F.ceil(F.col("n") / cell).cast("int"))
    met = met.withColumn("b", F.pmod(F.xxhash64("name"), F.col("nb")).cast("int"))
    parts = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least("b", j).alias("i"), F.greatest("b", j).alias("j")))
    met = met.select("t", "key", F.explode(parts).alias("p"), "fp", "name", "also").select("t", "key", "p.i", "p.j", "fp", "name", "also")
    met = met.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("simhash")
        keys = ["t", "key", "i", "j"]
        for part in sorted_groups(batches, keys):
            cols = [part.column(k).to_numpy() for k in keys]
            fresh = np.zeros(part.num_rows, bool)
            for c in cols:
                fresh[1:] |= c[1:] != c[:-1]
            fp, names, second = (part.column(k).to_numpy() for k in ("fp", "name", "also"))
            u, v = near_links(fp.view(np.uint64), np.cumsum(fresh), radius, second.view(np.uint64) if also else None, wide)
            yield pa.RecordBatch.from_pydict({"u": pa.array(names[u], pa.int64()), "v": pa.array(names[v], pa.int64())})

    return met.mapInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (hex), component_id (smallest doc_id that links lead to)."""
    rows = durable(fingerprints(docs, words, id_col, text_col))
    held = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(fingerprint_links(held.df, radius))
    known = held.df.join(roots, held.df["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    known = durable(known)
    held.drop()
    # Written, so that Spark can split a component that many fingerprints have.
    names = durable(known.groupBy("root").agg(F.min("first").alias("component_id")))
    named = known.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: For similar_documents(): documents of the frequency sample, hits in it from which a shingle is frequent, and how
#: many frequent shingles are kept.
SAMPLE, FREQUENT, MOST_FREQUENT = 16_384, 3, 200_000
#: Hash ranges that a document may pass over, as a share of those in which similar ones may differ.
SPARE = 0.25
#: Documents of a cluster that one task takes at a time; larger clusters go as pairs of such blocks.
CLUSTER = 4096
#: Distinct words whose hashes a worker keeps.
KNOWN = 100_000


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    z = x + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        x = self[word] = xxhash.xxh64_intdigest(word, 42)
        return x


_hashes = _WordHashes()
keeps("simhash", _hashes.clear)


def shingle_set(text: str, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the word shingles (of all words where there are fewer), and of the words."""
    if len(_hashes) > KNOWN:
        _hashes.clear()
    w = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(_hashes.__getitem__, w), np.uint64, len(w))
    if not len(h):
        return h, h
    size = min(words, len(h))
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = _mixed(out ^ h[k : k + n], k + 1)
    return np.unique(out), np.unique(h)


def _semi(df: DataFrame, keys: DataFrame, on: list[str], how: str, most: int = 1_000_000) -> DataFrame:
    """A semi or anti join; the keys are broadcast only where a count finds at most `most` of them."""
    return df.join(F.broadcast(keys) if keys.count() <= most else keys, on, how)


def frequent_shingles(rows: DataFrame, words: int = 5, sample: int = SAMPLE) -> np.ndarray:
    """Sorted hashes of shingles that a sample of the rows (mark, text) finds frequent."""
    share = min(1.0, sample / max(1, rows.count()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("simhash")
        for batch in batches:
            sets = [shingle_set(t, words)[0] for t in batch.column(0).to_pylist()]
            keys, hits = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "hits": pa.array(hits.astype(np.int64))})

    counted = rows.filter(F.pmod(F.xxhash64("mark"), F.lit(2**20)) < F.lit(share * 2**20)).select("text").mapInArrow(count, "key long, hits long")
    top = counted.groupBy("key").agg(F.sum("hits").alias("hits")).filter(F.col("hits") >= FREQUENT).orderBy(F.desc("hits"), "key").limit(MOST_FREQUENT)
    return np.sort(top.select("key").toArrow().column("key").to_numpy().view(np.uint64))


_starts: dict[float, list[int]] = {}


def size_classes(similarity: float, n: int) -> list[int]:
    """First sizes of the size classes, up to beyond n: similar sets are in the same class or in neighbouring ones."""
    starts = _starts.setdefault(similarity, [1])
    while starts[-1] <= n:
        starts.append(math.floor(starts[-1] / similarity + 1e-9) + 1)
    return starts


def range_signatures(shingles: np.ndarray, similarity: float, frequent: np.ndarray) -> np.ndarray:
    """Hashes of a set's parts in ranges of the hashes; sets of the similarity have one in common.

    Sets of which the smaller has at most `top` members differ in at most odd = top (1 - similarity) / similarity of
    them. The hashes are cut into odd + 1 + spare ranges, so at least spare + 1 of these hold the same members in both.
    Each set passes over the `spare` ranges with fewest rare members, in an order that the members themselves give:
    the best of the ranges that agree has `spare` others behind it in either set, so neither passes over that one.
    A set goes by the class of its own size and, for smaller partners, by the class below."""
    n = len(shingles)
    if not n:  # empty sets are alike
        return np.zeros(1, np.uint64)
    starts = size_classes(similarity, n)
    own = bisect.bisect_right(starts, n) - 1
    rare = np.ones(n, np.int64)
    if len(frequent):
        rare[frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles] = 0
    rare = np.concatenate([[0], np.cumsum(rare)])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(shingles, 11), dtype=np.uint64)])
    out = []
    for level in range(max(0, own - 1), own + 1):
        top = starts[level + 1] - 1
        odd = math.floor(top * (1 - similarity) / similarity + 1e-9)
        ranges = odd + 1 + int(SPARE * odd)
        edges = np.append(np.searchsorted(shingles, np.arange(ranges, dtype=np.uint64) * np.uint64((2**64 - 1) // ranges)), n)
        low, high = edges[:-1], edges[1:]
        taken = np.lexsort((low - high, rare[low] - rare[high]))[: odd + 1]
        part = (sums[high] - sums[low])[taken]
        out.append(_mixed(part ^ _mixed(taken.astype(np.uint64), level + 1), 12))
    return np.concatenate(out)


def candidate_links(rows: DataFrame, words: int, similarity: float, sample: int = SAMPLE) -> DataFrame:
    """Links (u, v) between marks that lead from each document to all similar ones, and to few others.

    Documents with a common range signature are chained, which is linear in their number."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent_shingles(rows, words, sample))

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            sizes = np.array([len(k) for k, _ in held], np.int64)
            return pa.RecordBatch.from_pydict({
                "key": pa.array(np.concatenate([k for k, _ in held]).view(np.int64)),
                "mark": pa.array(np.repeat(np.array([m for _, m in held], np.int64), sizes)),
            })

        begin("simhash")
        held, many = [], 0
        for batch in batches:
            for mark, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((range_signatures(shingle_set(t, words)[0], similarity, shared.value), mark))
                many += len(held[-1][0])
                if many >= 100_000:
                    yield out()
                    held, many = [], 0
        if held:
            yield out()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("simhash")
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, mark = (batch.column(k).to_numpy() for k in ("key", "mark"))
            if last:
                key, mark = (np.concatenate([[x], y]) for x, y in zip(last, (key, mark)))
            last = key[-1], mark[-1]
            met = (key[1:] == key[:-1]) & (mark[1:] != mark[:-1])
            yield pa.RecordBatch.from_pydict({"u": pa.array(mark[1:][met], pa.int64()), "v": pa.array(mark[:-1][met], pa.int64())})

    cells = rows.select("mark", "text").mapInArrow(signatures, "key long, mark long")
    return cells.repartition("key").sortWithinPartitions("key", "mark").mapInArrow(chain, "u long, v long")


def _compared(rows: DataFrame, clusters: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links (u, v) that connect all similar documents of each cluster (mark, root, known), but for those of the same
    `known`, which are connected already."""
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n")).filter("n > 1")
    spread = durable(clusters.join(sizes, "root").select("mark", "root", "known", F.ceil(F.col("n") / CLUSTER).cast("int").alias("nb")))

    # Texts are shuffled by cluster: they take half the room of their shingle sets. A repeated row links to itself,
    # which counts for nothing.
    few = F.broadcast(spread) if spread.count() <= 1_000_000 else spread
    met = rows.select("mark", "text").join(few, "mark").select("mark", "root", "known", "nb", "text")
    met = met.withColumn("b", F.pmod(F.xxhash64("mark"), F.col("nb")).cast("int"))
    parts = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least("b", j).alias("i"), F.greatest("b", j).alias("j")))
    met = met.select("root", F.explode(parts).alias("p"), "mark", "known", "text").select("root", "p.i", "p.j", "mark", "known", "text")
    met = met.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "mark")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("simhash")
        keys = ["root", "i", "j"]
        for part in sorted_groups(batches, keys):
            spot = list(zip(*(part.column(k).to_pylist() for k in keys)))
            marks = part.column("mark").to_pylist()
            known = part.column("known").to_numpy()
            texts = part.column("text")
            us, vs, at = [], [], 0
            while at < len(spot):
                end = at
                while end < len(spot) and spot[end] == spot[at]:
                    end += 1
                held = [shingle_set(t, words)[0] for t in texts.slice(at, end - at).to_pylist()]
                _, first, which = np.unique(known[at:end], return_index=True, return_inverse=True)
                for a, b in set_links(held, similarity, first[which]):
                    us.append(marks[at + a])
                    vs.append(marks[at + b])
                at = end
            yield pa.RecordBatch.from_pydict({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return met.mapInArrow(compare, "u long, v long")


def similar_documents(docs: DataFrame, words: int = 5, similarity: float = 0.8, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, component) of each distinct (id, text) that is like another: Jaccard of word shingles.

    Covering LSH groups the SimHash fingerprints, and in each group the shingle sets are compared exactly. Similar
    documents whose fingerprints differ in more bits are left to an exact way: range signatures, which all similar
    pairs have in common, make loose clusters, and those that are not connected yet are compared in the same manner.
    The sample only sets which ranges a signature passes over. mark is a hash of the text; component is the mark of
    its first member.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.col(id_col).cast("long"), text).alias("mark"))
    groups = near_duplicates(rows, id_col="mark").select(F.col("doc_id").alias("mark"), F.col("component_id").alias("root")).distinct()
    met = durable(components(_compared(rows, groups.withColumn("known", F.col("mark")), words, similarity)))

    loose = components(candidate_links(rows, words, similarity, sample))
    known = met.select(F.col("node").alias("mark"), F.col("root").alias("known"))
    loose = loose.select(F.col("node").alias("mark"), "root").join(known, "mark", "left").withColumn("known", F.coalesce("known", "mark"))
    loose = durable(loose)
    parted = loose.groupBy("root").agg(F.min("known").alias("a"), F.max("known").alias("b")).filter("a <> b").select("root")
    links = _compared(rows, loose.join(parted, "root", "left_semi"), words, similarity)

    same = components(met.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links))
    return rows.select("doc_id", "mark").distinct().join(same.select(F.col("node").alias("mark"), F.col("root").alias("component")), "mark")


def set_links(sets: list[np.ndarray], similarity: float, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning list of the pairs of sets whose Jaccard similarity is high enough; empty sets are alike.

    known has for each set the first one that it is linked to already.

    Members are counted exactly here, so the prefixes by rareness share little but for similar sets. Sets that share
    one of a prefix are met at growing distance in its list, pairs that are linked already are passed over, and lists
    whose sets are all linked are dropped."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    empty = np.flatnonzero(sizes == 0).tolist()
    out = [(empty[0], k) for k in empty[1:]]
    if not sizes.any():
        return out
    # Members of one set only come first in its prefix and meet nothing: they are counted, not kept.
    every = np.sort(np.concatenate(sets))
    again = every[1:][every[1:] == every[:-1]]
    del every
    shared, counts = np.unique(again, return_counts=True)
    if not len(shared):
        return out
    kept = []
    for x in sets:
        at = np.minimum(np.searchsorted(shared, x), len(shared) - 1)
        kept.append(at[shared[at] == x])
    common = np.array([len(x) for x in kept], np.int64)
    owner, member = np.repeat(np.arange(n), common), np.concatenate(kept)
    order = np.lexsort((member, counts[member], owner))
    owner, member = owner[order], member[order]
    place = np.arange(len(owner)) - np.repeat(np.cumsum(common) - common, common) + (sizes - common)[owner]
    first = sizes - np.maximum(1, np.ceil(similarity * sizes - 1e-9).astype(np.int64)) + 1
    inside = place < first[owner]
    owner, member = owner[inside], member[inside]
    order = np.lexsort((owner, sizes[owner], member))
    owner, member = owner[order], member[order]
    if not len(owner):
        return out
    starts = np.flatnonzero(np.diff(member, prepend=-1))
    group = np.cumsum(np.diff(member, prepend=-1) != 0) - 1
    label, tried, step = np.arange(n) if known is None else known, set(), 1
    at = np.flatnonzero((np.minimum.reduceat(label[owner], starts) != np.maximum.reduceat(label[owner], starts))[group])
    while len(at):
        at = at[at + step < len(owner)]
        at = at[group[at] == group[at + step]]
        a, b = owner[at], owner[at + step]
        met = (label[a] != label[b]) & (sizes[a] >= similarity * sizes[b] - 1e-9)
        us, vs = [], []
        for pair in np.unique(a[met] * n + b[met]).tolist():
            if pair not in tried:
                tried.add(pair)
                u, v = divmod(pair, n)
                both = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
                if both >= similarity * (len(sets[u]) + len(sets[v]) - both) - 1e-9:
                    us.append(u)
                    vs.append(v)
        if us:
            out += zip(us, vs)
            label = _relabelled(label, np.array(us), np.array(vs))
            low, high = np.minimum.reduceat(label[owner], starts), np.maximum.reduceat(label[owner], starts)
            at = at[(low != high)[group[at]]]
        step += 1
    return out


def _relabelled(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after links: the smallest label of each linked lot."""
    while True:
        old, low = label.copy(), np.minimum(label[a], label[b])
        for x in (label[a], label[b], a, b):
            np.minimum.at(label, x, low)
        label = label[label]
        if (label == old).all():
            return label


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without those of a similar document with a smaller id; one of each group stays.

    Covering LSH on SimHash fingerprints proposes them, range signatures propose the rest, and shingle sets are
    compared exactly. Rows that are equal in id and text are one document and stay or go together; null counts as empty, texts
    without words are alike, fewer words than a shingle has give one shingle; ties in similarity do not matter, as
    all links count; a null doc_id loses to every other; an empty table stays empty; other columns take no part."""
    found = durable(similar_documents(docs, words, similarity, SAMPLE, id_col, text_col))
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "mark")).alias("k"))
    gone = durable(found.join(first, "component").filter("mark <> k.mark").select("mark"))
    key = free_name(docs, "_near_mark")
    marked = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))))
    return _semi(marked, gone.withColumnRenamed("mark", key), [key], "left_anti").select(docs.columns)
