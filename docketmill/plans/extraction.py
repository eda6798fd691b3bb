"""The extraction plan: pages to pieces, events, status and markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import personal_data
from ..operators.durable import durable
from ..operators.pieces import case_events, case_flags, covers, extraction_metrics, fold_pages, page_pieces, render_case


def typed_pieces(pages: DataFrame) -> DataFrame:
    """Pages classified once and folded once: both are read several times, so both are written tables."""
    return durable(fold_pages(durable(page_pieces(pages))))


def case_people(pieces: DataFrame) -> DataFrame:
    """Personal data of all of a case's pieces."""
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordem", "texto"))), lambda x: x["texto"]), "\n")
    return pieces.groupBy("numero").agg(whole.alias("_t")).select("numero", personal_data(F.col("_t")).alias("dados_pessoais"))


def extract_cases(pages: DataFrame) -> DataFrame:
    """pages (numero, pag, text) to one row for each case: flags, phase, status, timeline, personal data."""
    pieces = typed_pieces(pages)
    flags = case_flags(case_events(pieces))
    return flags.join(case_people(pieces), "numero").join(extraction_metrics(pieces), "numero")


def render_cases(pages: DataFrame) -> DataFrame:
    pieces = typed_pieces(pages)
    return render_case(pieces, case_flags(case_events(pieces)), covers(pages), case_people(pieces))
