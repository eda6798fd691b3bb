"""Exact deduplication with a heavy-hitter split.

Method: a Misra-Gries pass over the digests of normalised texts finds every digest that could hold
more than 2/(k+1) of the rows. For those at most k digests the winner and the group size are
aggregated exactly (partial aggregation, no row of theirs is shuffled) and broadcast: at most k rows.
All other digests are aggregated by an ordinary shuffle and joined back; their largest group is bounded
by 2n/(k+1) rows.

Cases: null text counts as empty, empty texts equal one another; repeated rows (same doc_id) are
rows of their own and share the fate of their group (the one that stays is kept once: the rows equal
in (length, doc_id) are all the winner's copies and only one of them is marked kept); a null doc_id
sorts after every other; an empty table gives an empty result; extra columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin, durable, free_name, written

#: Counters of the Misra-Gries summary, and so the most digests that are ever broadcast.
HEAVY = 256
SPACES = "[\\x20\\x09-\\x0D]"


def normalised(text: Column) -> Column:
    """The text without the ASCII white space that the contract names; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def misra_gries(keys: Iterator[bytes], k: int) -> dict[bytes, int]:
    """At most k candidates; a key's count is too low by at most n / (k + 1)."""
    held: dict[bytes, int] = {}
    for key in keys:
        if key in held:
            held[key] += 1
        elif len(held) < k:
            held[key] = 1
        else:
            held = {x: n - 1 for x, n in held.items() if n > 1}
    return held


def heavy_digests(digests: DataFrame, column: str, k: int = HEAVY) -> DataFrame:
    """The at most k digests with the highest Misra-Gries estimates: all with over 2n/(k+1) rows are in it.

    Each task sends at most k summary rows; each of those counts at most n_p/(k+1) too little.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("exact_dedup")
        held = misra_gries((x for b in batches for x in b.column(0).to_pylist()), k)
        yield pa.RecordBatch.from_pydict({"digest": pa.array(list(held), pa.binary()), "n": pa.array(list(held.values()), pa.int64())})

    parts = digests.select(F.col(column).alias("digest")).mapInArrow(summary, "digest binary, n long")
    top = parts.groupBy("digest").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "digest").limit(k)
    return top.select("digest")


def _measured(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [
        F.col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("_len"),
        F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256)).alias("digest"),
    ]


def decide(rows: DataFrame, k: int = HEAVY) -> DataFrame:
    """rows (doc_id, _len, digest, _row; durable, _row unique) with _best, the row that stays, and group_size."""
    heavy = heavy_digests(rows, "digest", k)
    # The smallest of (-length, null last, id, row) is the row that stays.
    order = F.struct((-F.col("_len")).alias("l"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("_row").alias("r"))
    winners = (
        rows.join(F.broadcast(heavy), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min(order).alias("_best"), F.count("*").alias("group_size"))
    )
    winners = durable(winners)  # at most k rows
    easy = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # Partial aggregates and a join that Spark can split, not a window that takes a group into one task.
    best = rest.groupBy("digest").agg(F.min(order).alias("_best"), F.count("*").alias("group_size"))
    rest = rest.join(best, "digest")
    return easy.select(*rest.columns).unionByName(rest)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = HEAVY) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the most code points in the original text, then the
    smallest id, stays.
    """
    rows = durable(docs.select(*_measured(docs, id_col, text_col), F.monotonically_increasing_id().alias("_row")))
    return decide(rows, k).select(
        "doc_id",
        F.col("_best.i").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_best.r")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = HEAVY, most: int = 1_000_000) -> DataFrame:
    """The rows of docs that stay, unchanged. The rows that go are broadcast where a count finds at most `most`.

    Null and empty texts are one group; of repeated rows one stays; ties in length go to the smaller id; an empty
    table stays empty; other columns take no part, whatever their names."""
    names = [free_name(docs, n) for n in ("_digest", "_id", "_size")]
    digest, own, size = names
    # A row's key is worked out again where it is looked up, so no copy of the texts is written.
    key = dict(zip((own, size, digest), _measured(docs, id_col, text_col)))
    keyed = docs.withColumns(key)
    rows = written(keyed.select(F.col(own).alias("doc_id"), F.col(size).alias("_len"), F.col(digest).alias("digest"), F.lit(0).cast("long").alias("_row")))
    best = F.col("doc_id").eqNullSafe(F.col("_best.i")) & (F.col("_len") == -F.col("_best.l"))
    decided = decide(rows.df, k).groupBy("digest", "doc_id", "_len").agg(F.first(best).alias("best"), F.count("*").alias("n"))
    decided = durable(decided.filter("NOT best OR n > 1").select(F.col("digest").alias(digest), F.col("doc_id").alias(own), F.col("_len").alias(size), "best"))
    rows.drop()

    def matching(how: str, keys: DataFrame) -> DataFrame:
        few = F.broadcast(keys) if keys.count() <= most else keys
        a, b = keyed.alias("a"), few.alias("b")
        return a.join(b, F.col(f"a.{digest}").eqNullSafe(F.col(f"b.{digest}")) & F.col(f"a.{own}").eqNullSafe(F.col(f"b.{own}")) & (F.col(f"a.{size}") == F.col(f"b.{size}")), how)

    out = matching("left_anti", decided.select(*names)).select(docs.columns)
    repeated = decided.filter("best").select(*names)
    if repeated.isEmpty():
        return out
    # Rows that stay, but for others with the same id and text: one of each.
    return out.unionByName(matching("left_semi", repeated).dropDuplicates(names).select(docs.columns))
