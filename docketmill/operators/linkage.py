"""Record linkage: by case number, by exact name, by the most similar name."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import cnj, match_name
from .dedup import last_wins

# Scores that are accepted, and that need no review.
REVIEW, AUTO, SAME_CASE = 70.0, 90.0, 70.0


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def similarity(a: str, b: str) -> float:
    """200 * LCS / (len a + len b); two empty names are alike."""
    return 100.0 if not a and not b else 200.0 * common_subsequence(a, b) / (len(a) + len(b))


def _scores(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype="float64")


name_similarity = F.pandas_udf(_scores, DoubleType())


def prepare_paper(paper: DataFrame) -> DataFrame:
    """paper (idx, processo, nome, livro) with its case number and comparable name; blank names go."""
    rows = paper.filter(F.trim(F.coalesce("nome", F.lit(""))) != "")
    return rows.select("idx", F.coalesce("processo", F.lit("")).alias("processo"), cnj(F.col("processo")).alias("cnj"), F.trim("nome").alias("nome"), match_name(F.col("nome")).alias("nome_norm"), "livro")


def prepare_registry(registry: DataFrame) -> DataFrame:
    """registry (pos, id, processo, nome): trimmed, blank names gone, first of each case and name."""
    from .dedup import first_wins

    rows = registry.select("pos", F.trim("id").alias("id"), F.trim("processo").alias("processo"), F.trim("nome").alias("nome")).filter("nome <> ''")
    return first_wins(rows.withColumn("nome_norm", match_name(F.col("nome"))), ["processo", "nome_norm"], ["pos"])


#: Columns that letters are counted in; letters that share one only weaken the bound.
LETTERS = 64


def letter_counts(names: list[str]) -> np.ndarray:
    """For each name how often its letters come, by code point modulo LETTERS."""
    out = np.zeros((len(names), LETTERS), np.int16)
    for row, name in zip(out, names):
        row += np.bincount(np.array([ord(c) for c in name], np.int64) % LETTERS, minlength=LETTERS).astype(np.int16)
    return out


def best_names(mine: list[str], names: list[str], pos: np.ndarray) -> list[tuple[float, int] | None]:
    """For each of mine the highest similarity of REVIEW and more and its name's position, the smallest on ties.

    The letters that two names have in common bound their similarity, so few pairs are compared."""
    letters, sizes, out = letter_counts(names), np.array([len(n) for n in names]), []
    for name, bag in zip(mine, letter_counts(mine)):
        both = sizes + len(name)
        most = np.where(both > 0, 200.0 * np.minimum(letters, bag).sum(axis=1) / np.maximum(both, 1), 100.0)
        near = np.flatnonzero(most >= REVIEW)
        top: tuple[float, int] | None = None
        for k in near[np.argsort(-most[near], kind="stable")].tolist():
            if top and most[k] < top[0]:
                break
            s = similarity(name, names[k])
            if s >= REVIEW and (top is None or (s, -pos[k]) > (top[0], -top[1])):
                top = (s, int(pos[k]))
        out.append(top)
    return out


def fuzzy_candidates(left: DataFrame, names: DataFrame, block: int = 2000) -> DataFrame:
    """(idx, pos, score) of the best name for each of left: every name is compared, in blocks of both sides.

    Both sides are packed into arrays of about `block` by hash, and each pack of left meets each pack of the distinct
    names once; the best of each block is all that leaves it.
    """
    distinct = names.groupBy("nome_norm").agg(F.min("pos").alias("pos"))
    n, m = max(1, -(-distinct.count() // block)), max(1, -(-left.count() // block))
    packs = distinct.groupBy(F.pmod(F.xxhash64("nome_norm"), F.lit(n)).cast("int").alias("b")).agg(F.collect_list("nome_norm").alias("names"), F.collect_list("pos").alias("pos"))
    asked = left.groupBy(F.pmod(F.xxhash64("idx"), F.lit(m)).cast("int").alias("a")).agg(F.collect_list("idx").alias("idx"), F.collect_list("nome_norm").alias("mine"))
    spread = asked.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    pairs = spread.join(packs, "b").repartition(F.col("a"), F.col("b")).select("idx", "mine", "names", "pos")

    def best(batches):
        for batch in batches:
            out = []
            for idx, mine, others, pos in zip(*(batch.column(k).to_pylist() for k in range(4))):
                out += [(i, top[1], top[0]) for i, top in zip(idx, best_names(mine, others, np.array(pos))) if top]
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], ["idx", "pos", "score"])

    got = pairs.mapInArrow(best, "idx long, pos long, score double")
    return got.groupBy("idx").agg(F.max(F.struct("score", (-F.col("pos")).alias("p"))).alias("w")).select("idx", (-F.col("w.p")).alias("pos"), F.col("w.score").alias("score"))


def link(paper: DataFrame, registry: DataFrame) -> DataFrame:
    """Each row of prepared paper with its match in the prepared registry: metodo cnj, exato, fuzzy or sem_match."""
    p = paper.select("idx", F.col("nome").alias("papel_nome"), F.col("processo").alias("papel_processo"), F.col("livro").alias("papel_livro"), "cnj", "nome_norm")
    base = ["idx", "papel_nome", "papel_processo", "papel_livro"]
    r = registry.select("pos", F.col("id").alias("pje_id_processo"), F.col("processo").alias("pje_processo"), F.col("nome").alias("pje_nome"), F.col("nome_norm").alias("_name"))
    found = ["pje_nome", "pje_processo", "pje_id_processo"]

    same = p.join(r, p["cnj"] == r["pje_processo"]).withColumn("_s", name_similarity("nome_norm", "_name"))
    nth = F.row_number().over(Window.partitionBy("idx").orderBy(F.desc("_s"), "pos"))
    same = same.withColumn("_n", nth).filter("_n = 1")
    same = same.select(*base, *found, F.greatest(F.lit(95), F.floor("_s").cast("int")).alias("score"), F.lit("cnj").alias("metodo"), (F.col("_s") < SAME_CASE).alias("revisar"))

    left = p.join(same.select("idx"), "idx", "left_anti")
    last = last_wins(r, ["_name"], ["pos"])
    exact = left.join(last, left["nome_norm"] == last["_name"]).select(*base, *found, F.lit(92).alias("score"), F.lit("exato").alias("metodo"), F.lit(False).alias("revisar"))

    left = left.join(last.select("_name"), left["nome_norm"] == F.col("_name"), "left_anti")
    near = fuzzy_candidates(left, r.select("pos", F.col("_name").alias("nome_norm")))
    fuzzy = left.join(near, "idx", "left").join(r, "pos", "left")
    none = F.col("pje_nome").isNull()
    fuzzy = fuzzy.select(
        *base, *found,
        F.when(none, 0).otherwise(F.floor("score").cast("int")).alias("score"),
        F.when(none, "sem_match").otherwise("fuzzy").alias("metodo"),
        (none | (F.col("score") < AUTO)).alias("revisar"),
    )
    return same.unionByName(exact).unionByName(fuzzy)


def link_summary(matches: DataFrame) -> DataFrame:
    """Per method: n, percent of all, and how many to review."""
    by = matches.groupBy("metodo").agg(F.count("*").alias("n"), F.count_if("revisar").alias("revisar"))
    return by.withColumn("percent", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))) * 100)
