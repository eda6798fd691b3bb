"""The triage plan: cases to batches, records to the ranked table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import accepted_class, class_route
from ..operators.consolidate import enrich
from ..operators.queues import enrich_cases, fixed_batches


def build_queue(cases: DataFrame, texts: DataFrame, done: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Batches of the cases that are not done; items of one num belong together."""
    wanted = cases.filter(accepted_class(F.col("classe"), classes or []))
    items = enrich_cases(wanted, texts, done).filter(~F.col("ja")).withColumn("prompt", class_route(F.col("classe"), F.col("assunto")))
    return fixed_batches(items, "prompt", [F.desc("score"), F.asc("pos")], "tem_pdf")


def rank_records(records: DataFrame) -> DataFrame:
    """Records by priority; place is the rank, ties in input order (pos)."""
    from ..operators.queues import global_rank

    return global_rank(enrich(records), [F.desc("score_prioridade"), F.asc("pos")], name="place")
