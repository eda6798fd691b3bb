"""Groups of cases from workbook rows: sheets, headers, columns, collection and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import cnj, sheet_key, sheet_prefix
from .dedup import collect_in_order
from .queues import name_order, sequential_ids


def resolve_sheets(wanted: list[str], rows: DataFrame) -> DataFrame:
    """(ord, wanted, sheet): by name, by former name, by comparable name; unresolved ones are left out."""
    spark = rows.sparkSession
    alias = dict(V.SHEET_ALIASES)
    ask = spark.createDataFrame([(i, w, alias.get(w)) for i, w in enumerate(wanted)], "ord int, wanted string, alias string")
    have = rows.select("sheet").distinct()
    fits = F.when(F.col("sheet") == F.col("wanted"), 0).when(F.col("sheet") == F.col("alias"), 1).when(sheet_key(F.col("sheet")) == sheet_key(F.col("wanted")), 2)
    # The sheets of a workbook against the few that are asked for.
    met = have.join(F.broadcast(ask), fits.isNotNull()).withColumn("rank", fits)
    return met.groupBy("ord", "wanted").agg(F.min(F.struct("rank", "sheet")).alias("w")).select("ord", "wanted", F.col("w.sheet").alias("sheet"))


def header_rows(rows: DataFrame, most: int = 5) -> DataFrame:
    """(sheet, row_no, header): the first of the first rows with a cell `grupo` and one with `processo`."""
    keys = F.transform("cells", lambda c: sheet_key(c))
    ok = F.exists(keys, lambda k: k == "grupo") & F.exists(keys, lambda k: k.contains("processo"))
    found = rows.filter(F.col("row_no") <= most).filter(ok)
    return found.groupBy("sheet").agg(F.min(F.struct("row_no", F.col("cells").alias("header"))).alias("h")).select("sheet", "h.row_no", "h.header")


def column_index(header, *targets: str):
    """0-based place of the first column equal to a target, else of the first that holds one; null: none."""
    keys = F.transform(header, lambda c: sheet_key(c))
    wants = [sheet_key(F.lit(t)) for t in targets]
    equal = F.transform(keys, lambda k: F.array(*wants).cast("array<string>").isNotNull() & F.array_contains(F.array(*wants), k))
    holds = F.transform(keys, lambda k: F.exists(F.array(*wants), lambda w: (w != "") & k.contains(w)))
    at = lambda flags: F.nullif(F.array_position(flags, True), F.lit(0)) - 1
    return F.coalesce(at(equal), at(holds)).cast("int")


def case_groups(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """Groups with at least two cases from rows (sheet, row_no, cells): ids by sheet and group name."""
    heads = header_rows(rows).withColumns({
        "c_grupo": column_index(F.col("header"), "Grupo"),
        "c_proc": column_index(F.col("header"), "Nº Processo", "N Processo", "Numero do Processo", "Processo"),
        "c_ativo": column_index(F.col("header"), "Polo Ativo"),
        "c_passivo": column_index(F.col("header"), "Polo Passivo"),
        "c_classe": column_index(F.col("header"), "Classe"),
        "c_assunto": column_index(F.col("header"), "Assunto"),
        "c_status": column_index(F.col("header"), "Status"),
    }).withColumnRenamed("row_no", "head_no")
    data = rows.join(resolve_sheets(wanted, rows), "sheet").join(heads, "sheet").filter("row_no > head_no AND c_grupo IS NOT NULL AND c_proc IS NOT NULL")
    cell = lambda c: F.trim(F.coalesce(F.get("cells", F.col(c)), F.lit("")))
    data = data.select("ord", "sheet", "row_no", cell("c_grupo").alias("grupo"), cnj(cell("c_proc")).alias("processo"), *[cell(f"c_{k}").alias(k) for k in ("ativo", "passivo", "classe", "assunto", "status")])
    data = data.filter("grupo <> '' AND processo IS NOT NULL")
    got = data.groupBy("ord", "sheet", "grupo").agg(*[collect_in_order(F.col(c), F.col("row_no")).alias(c) for c in ("processo", "ativo", "passivo", "classe", "assunto", "status")])
    got = got.filter(F.size("processo") >= 2).withColumn("prefixo", sheet_prefix(F.col("sheet")))
    got = sequential_ids(got, "prefixo", [F.col("ord"), *name_order(F.col("grupo"))])
    side = lambda c: F.array_join(F.slice(c, 1, 2), " ↔ ")
    parties = F.when((side("ativo") != "") | (side("passivo") != ""), F.concat(side("ativo"), F.lit(" vs "), side("passivo"))).otherwise("")
    few = lambda c, n: F.array_join(F.slice(c, 1, n), "; ")
    return got.select(
        "group_id", F.col("sheet").alias("aba_origem"), F.col("grupo").alias("grupo_planilha"), F.col("processo").alias("processos"), F.size("processo").alias("n_processos"),
        F.substring(parties, 1, 160).alias("partes_amostra"), few("classe", 3).alias("classe_amostra"), few("assunto", 3).alias("assunto_amostra"), few("status", 5).alias("status_amostra"),
    )
