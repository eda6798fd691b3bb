"""Packing documents into sequences by a configuration linear program over the length histogram.

Method: the histogram of piece lengths (at most `capacity` counts, whatever the number of documents) goes
to the driver. Pieces of over capacity / SAND tokens fall into at most GROUPS groups of neighbouring lengths,
each as long as its longest; what is shorter is sand, of which only the volume counts. A configuration is
a multiset of groups that fits one sequence, the rest of it room for sand. The program "least number of
configurations that cover every group and the sand" is solved as a game by multiplicative weights: prices of
groups rise where they are covered least, shares of configurations where they earn most, both foresee
the other's last step, and the averages are the fractional solution and its dual prices. A knapsack by
dynamic programming over the capacity prices out new configurations until the two bounds meet or ROUNDS
are over. The solution is then rounded: each configuration is taken its whole number of times and once
more with the chance of its fraction, slots are filled with the longest pieces of their groups, and all
other pieces are placed best-fit, longest first, into the room that is left or new sequences. Of the shares in
SHARES of the solution the one that needs the fewest sequences stays, as rounding lengths up to groups costs room.

Everything is counted by length, so neither step depends on the number of documents. Pieces then
find their place from their rank within their length: ranks are counted in hash buckets of each length, so
one frequent length is spread over many tasks.

Cases: null text counts as empty, an empty document is its end id alone; repeated rows are packed as rows of
their own; an empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import LIMIT, ids_of, word_bpe
from .common import begin, durable, partitions_for

CAPACITY = 2048
#: Groups of lengths in the program; lengths up to 1 / SAND of the capacity are sand.
GROUPS, SAND = 160, 16
#: Pricings at most, steps of the game between two of them, its rate, and configurations that are kept.
ROUNDS, STEPS, RATE, KEEP = 40, 300, 0.5, 500
#: Relative distance of the program's bounds at which it counts as solved.
GAP = 0.0005
#: Shares of the fractional solution that are rounded; the rest of the pieces is placed best-fit.
SHARES = (1.0, 0.99, 0.97, 0.9, 0.5)


class Solution(NamedTuple):
    """Configurations (rows: pieces of each group, then room for sand), how often each is taken, and two bounds:
    the number of sequences of the fractional solution, and one that no packing of these lengths can beat."""

    groups: list[np.ndarray]
    configurations: np.ndarray
    times: np.ndarray
    sequences: float
    bound: float


def length_groups(counts: np.ndarray, capacity: int, most: int = GROUPS) -> list[np.ndarray]:
    """Neighbouring lengths over the sand; the more frequent, the narrower a group.

    No group has lengths of which different numbers fit one sequence, nor more of a gap than a hundredth of one."""
    sizes = np.flatnonzero(counts)
    sizes = sizes[sizes * SAND > capacity]
    if len(sizes) <= most:
        return [np.array([s]) for s in sizes]
    weight = np.sqrt(counts[sizes])
    at = np.cumsum(weight) - weight / 2
    group = np.minimum((at * most / weight.sum()).astype(int), most - 1)
    cut = (np.diff(group) > 0) | (np.diff(capacity // sizes) != 0) | (np.diff(sizes) * 100 > capacity)
    return np.split(sizes, np.flatnonzero(cut) + 1)


def knapsack(sizes: np.ndarray, prices: np.ndarray, sand: float, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room the highest price that fits it, and a size (its number) to begin with; -1: a token of sand."""
    best, pick = sand * np.arange(capacity + 1.0), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(int(sizes[0]), capacity + 1):
        m = fits[c]
        total = prices[:m] + best[c - sizes[:m]]
        k = int(total.argmax())
        best[c] = best[c - 1] + sand
        if total[k] > best[c]:
            best[c], pick[c] = total[k], k
    return best, pick


def priced_out(pick: np.ndarray, sizes: np.ndarray, capacity: int) -> dict[bytes, np.ndarray]:
    """The best configuration, and the best ones with each of the groups in them."""
    at = np.maximum.accumulate(np.where(pick >= 0, np.arange(capacity + 1), -1))
    out = {}
    for first in range(-1, len(sizes)):
        column, room = np.zeros(len(sizes) + 1), capacity
        if first >= 0:
            column[first], room = 1, capacity - sizes[first]
        while at[room] >= 0:
            k = pick[at[room]]
            column[k] += 1
            room = at[room] - sizes[k]
        column[-1] = capacity - (column[:-1] * sizes).sum()
        out[column.tobytes()] = column
    return out


def play(payoff: np.ndarray, shares: np.ndarray, prices: np.ndarray, steps: int = STEPS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """Average strategies of a game by optimistic multiplicative weights. payoff[row, column]: how far a column covers a row."""
    x, p = np.log(np.maximum(shares, 1e-7)), np.log(np.maximum(prices, 1e-9))
    last_x, last_p = np.zeros(len(x)), np.zeros(len(p))
    sum_x, sum_p = np.zeros(len(x)), np.zeros(len(p))
    for step in range(steps):
        share, price = np.exp(x - x.max()), np.exp(p - p.max())
        share, price = share / share.sum(), price / price.sum()
        # Not by the matrix product, whose threads cost more than such small matrices.
        earned, covered = np.einsum("i,ij->j", price, payoff), np.minimum(np.einsum("ij,j->i", payoff, share), 3.0)
        x += rate * (2 * earned - last_x)
        p -= rate * (2 * covered - last_p)
        last_x, last_p = earned, covered
        if 3 * step >= steps:
            sum_x += share
            sum_p += price
    return sum_x / sum_x.sum(), sum_p / sum_p.sum()


def solve(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> Solution:
    """The fractional configuration program of a histogram: counts[s] pieces of length s."""
    length = np.arange(len(counts))
    volume = -(-int((counts * length).sum()) // capacity)
    groups = length_groups(counts, capacity)
    if not groups:
        return Solution([], np.zeros((0, 1)), np.zeros(0), float(volume), float(volume))
    sizes, least = np.array([g.max() for g in groups]), np.array([g.min() for g in groups])
    need = np.append([counts[g].sum() for g in groups], (counts * length)[length * SAND <= capacity].sum()).astype(float)
    rows = np.flatnonzero(need > 0)
    held = {}
    for k, s in enumerate(sizes.tolist()):
        column = np.zeros(len(need))
        column[k], column[-1] = capacity // s, capacity % s
        held[column.tobytes()] = column
    column = np.append(np.zeros(len(sizes)), capacity)
    held[column.tobytes()] = column
    prices = need * np.append(np.maximum(sizes / capacity, 1 / (capacity // sizes)), 1 / capacity)
    prices /= prices.sum()
    shares: dict[bytes, float] = {}
    dual, real, sequences, found = 0.0, float(volume), np.inf, None
    for _ in range(rounds):
        each = prices / np.where(need > 0, need, 1)
        best, pick = knapsack(sizes, each[:-1], each[-1], capacity)
        dual = max(dual, 1 / best[capacity])
        # Groups as long as their shortest piece: what these prices prove holds for the pieces themselves.
        real = max(real, 1 / knapsack(least, each[:-1], each[-1], capacity)[0][capacity])
        if sequences <= dual * (1 + GAP):
            break
        kept = sorted(held, key=lambda k: -shares.get(k, 0.0))[:KEEP]
        held = {k: held[k] for k in kept} | priced_out(pick, sizes, capacity)
        columns = np.array(list(held.values()))
        payoff = np.ascontiguousarray(columns[:, rows].T / need[rows, None] * dual)
        begin = np.array([shares.get(k, 0.0) or 0.05 / len(held) for k in held])
        x, p = play(payoff, begin, prices[rows])
        shares, prices = dict(zip(held, x)), np.zeros(len(need))
        prices[rows] = p
        now = dual / np.einsum("ij,j->i", payoff, x).min()
        if now < sequences:
            sequences, found = now, (columns, x * now)
    return Solution(groups, *found, sequences, real)


Bins = list[tuple[list[int], int]]


def round_off(solution: Solution, counts: np.ndarray, share: float) -> tuple[Bins, np.ndarray]:
    """Configurations taken whole numbers of times, with the lengths of real pieces in their slots; pieces that are left."""
    left, bins, rng = counts.copy(), [], np.random.default_rng(5)
    for j in np.argsort(-solution.times, kind="stable").tolist():
        times = int(solution.times[j] * share + rng.random())
        slots = [(solution.groups[g], int(solution.configurations[j, g])) for g in np.flatnonzero(solution.configurations[j, :-1])]
        while times > 0:
            lengths, most = [], times
            for group, n in slots:
                for s in group[left[group] > 0][::-1].tolist():
                    k = min(n, int(left[s]))
                    lengths += [s] * k
                    most, n = min(most, int(left[s]) // k), n - k
                    if not n:
                        break
            if not lengths:
                break
            for s in lengths:
                left[s] -= most
            bins.append((lengths, most))
            times -= most
    return bins, left


def best_fit(left: np.ndarray, bins: Bins, capacity: int) -> Bins:
    """Place the pieces that are left, longest first, each where the least room is left; equal sequences at once."""
    done: Bins = []
    open_: dict[int, Bins] = {}
    rooms: list[int] = []

    def put(lengths: list[int], times: int, room: int) -> None:
        if room and times:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((lengths, times))
        elif times:
            done.append((lengths, times))

    for lengths, times in bins:
        put(lengths, times, capacity - sum(lengths))
    for s in np.flatnonzero(left)[::-1].tolist():
        n = int(left[s])
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                fits = capacity // s
                put([s] * fits, n // fits, capacity - fits * s)
                put([s] * (n % fits), n % fits and 1, capacity - n % fits * s)
                break
            room = rooms[at]
            lengths, times = open_[room].pop()
            fits = min(room // s, n)
            taken = min(times, n // fits)
            if taken < times:
                open_[room].append((lengths, times - taken))
            elif not open_[room]:
                del open_[room], rooms[at]
            put(lengths + [s] * fits, taken, room - fits * s)
            n -= taken * fits
    return done + [b for room in rooms for b in open_[room]]


def plan_configurations(counts: np.ndarray, capacity: int = CAPACITY, solution: Solution | None = None) -> Bins:
    """Configurations (lengths in order of place) and how many sequences use each. counts[s]: pieces of length s."""
    solution = solution or solve(counts, capacity)
    best: tuple[int, Bins] | None = None
    for share in SHARES if solution.groups else (0.0,):
        bins, left = round_off(solution, counts, share)
        bins = best_fit(left, bins, capacity)
        n = sum(times for _, times in bins)
        if best is None or n < best[0]:
            best = n, bins
        if n <= np.ceil(solution.bound - 1e-6):
            break
    return best[1]


def places(plan: list[tuple[list[int], int]], capacity: int = CAPACITY) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks of runs of places, the runs' first sequences, their offsets."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used, base = np.zeros(capacity + 1, np.int64), 0
    for lengths, times in plan:
        at = 0
        for s in lengths:
            out.setdefault(s, []).append((int(used[s]), base, at))
            used[s] += times
            at += s
        base += times
    return {s: tuple(np.array(x, np.int64) for x in zip(*runs)) for s, runs in out.items()}


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: documents cut only where they are longer than the capacity.

    limit: chunks that a worker's table holds at most; fewer take less memory and more time, the result is the same."""
    tail, step = int(end_id).to_bytes(4, "little"), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(f"packing {limit}")
        table = word_bpe(tokenizer, limit)
        for batch in batches:
            data = ids_of(table, batch.column(1)).to_pylist()
            sizes = np.array([len(x) // 4 + 1 for x in data], np.int64)
            parts = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(data)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            crc = []
            for x, n in zip(data, parts.tolist()):
                whole = x + tail
                crc += [zlib.crc32(whole[at : at + step]) for at in range(0, n * step, step)] if n > 1 else [zlib.crc32(whole)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(np.minimum(capacity, sizes[doc] - start), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int | None = None) -> DataFrame:
    """Give every piece its sequence_id and offset. pieces must be durable: it is read twice."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    where = pieces.sparkSession.sparkContext.broadcast(places(plan_configurations(counts, capacity), capacity))
    k = buckets or max(64, 4 * partitions_for(pieces), int(counts.max()) // 1_000_000)
    rows = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(k)).cast("int"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    nth = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = rows.join(sums, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + nth - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = batch.column("_rank").to_numpy(), batch.column("length").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(length).tolist():
                at = np.flatnonzero(length == s)
                firsts, bases, offsets = where.value[s]
                run = np.searchsorted(firsts, rank[at], side="right") - 1
                sequence[at], offset[at] = bases[run] + rank[at] - firsts[run], offsets[run]
            out = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(sequence), pa.array(offset)], [*out.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, limit: int = LIMIT) -> DataFrame:
    """Tokenize, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(durable(token_pieces(docs, tokenizer, capacity, end_id, limit=limit)), capacity)
