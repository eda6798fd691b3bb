"""Consolidation of annotation results: ranking, explosion, flattening and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scoring

# The categories that statistics always list.
CLASSIFICATIONS = ["LITISPENDENCIA_TOTAL", "LITISPENDENCIA_PARCIAL", "COISA_JULGADA", "CONEXAO", "CONTINENCIA", "CAUSAS_DISTINTAS", "INDEFINIDO"]
PRIORITIES = ["URGENTE", "ALTA", "MEDIA", "BAIXA"]
CONFIDENCES = ["ALTA", "MEDIA", "BAIXA"]


def enrich(triage: DataFrame) -> DataFrame:
    """Triage records with score, goal, level; stored executor and ease stay where they are truthy.

    The score uses the ease of the act's keywords even where another one is stored.
    """
    days, custody = scoring.parsed_days(F.col("dias_parado")), scoring.parsed_flag(F.col("reu_preso"))
    crime = F.coalesce("urgencia_crime", "urgencia", F.lit("MEDIA")) if "urgencia" in triage.columns else F.coalesce("urgencia_crime", F.lit("MEDIA"))
    rows = triage.withColumn("_p", scoring.priority(F.coalesce("risco_prescricao", F.lit("SEM RISCO")), days, F.coalesce("proximo_ato", F.lit("")), custody, crime))
    return rows.withColumns({
        "score_prioridade": F.col("_p.score_prioridade"),
        "meta_principal": F.col("_p.meta_principal"),
        "executor": F.coalesce(F.nullif("executor", F.lit("")), "_p.executor"),
        "facilidade_ato": F.coalesce(F.nullif("facilidade_ato", F.lit(0)), "_p.facilidade_ato"),
        "nivel_prioridade": scoring.level(F.col("_p.score_prioridade")),
    }).drop("_p")


def ranked_sheet(enriched: DataFrame) -> DataFrame:
    """The ranked table as it is shown: custody and ease by their display names."""
    return enriched.withColumns({"reu_preso": scoring.custody_text(scoring.parsed_flag(F.col("reu_preso"))), "facilidade_ato": scoring.ease_text(F.col("facilidade_ato"))})


def ranked_groups(analyses: DataFrame) -> DataFrame:
    """By priority (unknown last), then size, then input order; the place is a column."""
    from .queues import global_rank

    place = reduce(lambda acc, kv: F.when(F.col("prioridade") == kv[1], kv[0]).otherwise(acc), enumerate(PRIORITIES), F.lit(4))
    return global_rank(analyses, [place, F.col("n_processos").desc(), F.col("pos")], name="place")


def pair_rows(analyses: DataFrame) -> DataFrame:
    """A row for each pair: its first two cases, the rest joined."""
    p = analyses.select("group_id", F.explode("pares_litispendencia").alias("p"))
    cases = F.col("p.processos")
    rest = F.array_join(F.slice(cases, 3, F.greatest(F.size(cases) - 2, F.lit(0))), ", ")
    return p.select("group_id", F.coalesce(F.get(cases, F.lit(0)), F.lit("")).alias("processo_a"), F.coalesce(F.get(cases, F.lit(1)), F.lit("")).alias("processo_b"), F.coalesce(rest, F.lit("")).alias("outros"), F.col("p.tipo").alias("tipo"), F.col("p.justificativa").alias("justificativa"))


def distinct_rows(analyses: DataFrame) -> DataFrame:
    return analyses.select("group_id", F.explode("processos_distintos").alias("d")).select("group_id", "d.numero", "d.justificativa")


def category_counts(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """Counts of fixed categories, zero where none; one aggregate without a group, then one row each."""
    counts = df.agg(*[F.count_if(F.col(column) == c).alias(f"c{i}") for i, c in enumerate(categories)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("categoria"), F.col(f"c{i}").alias("n")) for i, c in enumerate(categories)])).alias("r")).select("r.*")


def statistics(analyses: DataFrame) -> dict[str, DataFrame]:
    """The statistics sheet: fixed categories, sheets by frequency, nested totals (missing lists count 0)."""
    total = lambda c: F.coalesce(F.sum(F.coalesce(F.size(c), F.lit(0))), F.lit(0)).alias(c)
    return {
        "classificacao": category_counts(analyses, "classificacao_final", CLASSIFICATIONS),
        "prioridade": category_counts(analyses, "prioridade", PRIORITIES),
        "confianca": category_counts(analyses, "confianca", CONFIDENCES),
        "aba": analyses.groupBy("aba_origem").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "aba_origem"),
        "totais": analyses.agg(F.count("*").alias("grupos"), *[total(c) for c in ("pares_litispendencia", "processos_distintos", "processos_coisa_julgada")]),
    }


def level_counts(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("nivel_prioridade").agg(F.count("*").alias("n"))


def executor_counts(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("executor").agg(F.count("*").alias("n"))


def goal_counts(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("meta_principal").agg(F.count("*").alias("n"))


def risk_counts(enriched: DataFrame) -> DataFrame:
    """One row: cases whose limitation has passed, is near or needs a look, and cases in custody."""
    risk = lambda r: F.count_if(F.col("risco_prescricao") == r)
    return enriched.agg(risk("PRESCRITO").alias("prescritos"), risk("IMINENTE").alias("iminentes"), risk("ATENCAO").alias("atencao"), F.count_if(scoring.parsed_flag(F.col("reu_preso"))).alias("presos"))


def file_count(files: DataFrame) -> DataFrame:
    """One row: how many files a listing (path) has."""
    return files.agg(F.count("path").alias("arquivos"))


def size_buckets(groups: DataFrame, size: str = "n_processos") -> DataFrame:
    n = F.col(size)
    return groups.agg(F.count_if(n <= 3).alias("pequenos"), F.count_if((n >= 4) & (n <= 5)).alias("medios"), F.count_if(n >= 6).alias("grandes"))


def coverage(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the groups' cases (array processos) how many have a text (stem)."""
    from ..functions.text import file_of_case_number

    cases = groups.select(F.explode("processos").alias("numero"))
    marked = cases.join(texts.select("stem").distinct(), file_of_case_number(F.col("numero"), "") == F.col("stem"), "left")
    return marked.agg(F.count("*").alias("total"), F.count("stem").alias("com_texto"))


def run_totals(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"), F.sum("paginas").alias("paginas"))


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as dotted columns, lists as `; `-joined text; lists of structs by their JSON."""

    def walk(c: Column, kind: T.DataType, name: str) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [x for f in kind.fields for x in walk(c.getField(f.name), f.dataType, f"{name}.{f.name}")]
        if isinstance(kind, T.ArrayType):
            deep = isinstance(kind.elementType, (T.StructType, T.MapType, T.ArrayType))
            each = lambda x: F.to_json(x) if deep else F.coalesce(x.cast("string"), F.lit("None"))
            return [F.array_join(F.transform(c, each), "; ").alias(name)]
        return [c.alias(name)]

    return df.select(*[x for f in df.schema.fields for x in walk(F.col(f"`{f.name}`"), f.dataType, f.name)])


def union_flattened(frames: list[DataFrame]) -> DataFrame:
    """Flattened rows of all frames; columns as first seen, empty text where a frame lacks one."""
    flat = [flatten(f) for f in frames]
    flat = [f.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in f.columns]) for f in flat]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), flat)
    return out.fillna("")


def share_of_total(df: DataFrame, n: str = "n") -> DataFrame:
    """df (a few groups) with each group's percent."""
    return df.withColumn("percent", F.col(n) / F.sum(n).over(Window.partitionBy(F.lit(1))) * 100)
