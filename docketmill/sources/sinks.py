"""Writers of results: tables, queue texts, workbooks of bounded reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workbook import write_workbook

# The columns of the ranked table.
RANKED = ["numero", "classe", "assunto", "dias_parado", "fase_processual", "proximo_ato", "urgencia_crime", "risco_prescricao", "reu_preso", "executor", "facilidade_ato", "meta_principal", "score_prioridade", "nivel_prioridade", "resumo", "fundamentacao_legal"]
#: Rows that a workbook sheet may hold; the format's own limit.
SHEET_ROWS = 1_048_575


def write_ranked_csv(ranked: DataFrame, path: str) -> None:
    """The ranked columns, others ignored; one file for each range of scores."""
    ranked.select(*[c for c in RANKED if c in ranked.columns]).orderBy(F.desc("score_prioridade")).write.mode("overwrite").option("header", True).csv(path)


def workbook_of(sheets: dict[str, DataFrame]) -> bytes:
    """A workbook of reports. A sheet with more rows than the format holds is an error, not cut."""
    out = {}
    for name, df in sheets.items():
        rows = df.limit(SHEET_ROWS + 1).collect()
        if len(rows) > SHEET_ROWS:
            raise ValueError(f"{name} has more rows than a sheet holds; write it as CSV or Parquet")
        out[name] = (df.columns, [[v if isinstance(v, (int, float, str, type(None))) else str(v) for v in r] for r in rows])
    return write_workbook(out)


def link_json(matches: DataFrame) -> DataFrame:
    """Matches as one JSON object for each paper case number; blanks go, the last one stays."""
    from ..operators.dedup import last_wins

    kept = last_wins(matches.filter("papel_processo <> ''"), ["papel_processo"], ["idx"])
    return kept.select("papel_processo", F.to_json(F.struct(*matches.columns)).alias("json"))


def command_text(num: Column, cases: Column, available: Column, head: str = "# === CMD ") -> Column:
    """A command's block: head line, then each case with a mark whether its text is at hand."""
    lines = F.transform(F.arrays_zip(cases.alias("c"), available.alias("a")), lambda x: F.concat(F.when(x["a"], "✓ ").otherwise("✗ "), x["c"]))
    return F.concat(F.lit(head), num.cast("string"), F.lit(" ===\n"), F.array_join(lines, "\n"))


def queue_json(commands: DataFrame) -> DataFrame:
    return commands.select(F.to_json(F.struct(*commands.columns)).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
