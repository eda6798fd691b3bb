"""Urgency and priority of cases: Column to Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .classify import ease_of, executor_of, folded_act
from .regex import bound
from .text import filled

# Subjects, weights and thresholds.
GRAVE = ["homicídio", "latrocínio", "estupro", "vulnerável"]
SERIOUS = ["tráfico", "roubo", "armas", "violência doméstica", "mulher", "medida protetiva"]
RISK = {"PRESCRITO": 15000, "IMINENTE": 12000, "ATENCAO": 10000, "BAIXO": 500, "SEM RISCO": 0}
STALL = [(1825, 5000), (1095, 4000), (730, 3000), (365, 2000), (180, 1000)]
CRIME = {"CRITICA": 800, "ALTA": 400, "MEDIA": 200, "BAIXA": 100}
LEVELS = [(15000, "URGENTÍSSIMA"), (10000, "URGENTE"), (5000, "ALTA"), (2000, "MÉDIA")]


def _steps(value: Column, steps: list, other) -> Column:
    return reduce(lambda acc, s: F.when(value >= s[0], F.lit(s[1])).otherwise(acc), reversed(steps), F.lit(other))


def _lookup(value: Column, table: dict, other) -> Column:
    return reduce(lambda acc, kv: F.when(value == kv[0], F.lit(kv[1])).otherwise(acc), table.items(), F.lit(other))


def urgency(days: Column, subject: Column, case_class: Column) -> Column:
    """struct<score, urgencia>."""
    s = F.lower(filled(subject))
    has = lambda words: reduce(lambda a, b: a | b, [s.contains(w) for w in words])
    score = days + F.when(has(GRAVE) | (filled(case_class) == "Juri"), 2000).when(has(SERIOUS), 1000).otherwise(0)
    score = (score + F.when(days > 730, 500).when(days > 365, 300).otherwise(0)).cast("int")
    return F.struct(score.alias("score"), _steps(score, [(1500, "CRITICA"), (800, "ALTA"), (400, "MEDIA")], "BAIXA").alias("urgencia"))


def impact(risk: Column, days: Column, in_custody: Column, crime: Column) -> Column:
    return _lookup(risk, RISK, 0) + _steps(days, STALL, 500) + F.when(in_custody, 3000).otherwise(0) + _lookup(crime, CRIME, 200)


def goal(risk: Column, days: Column, in_custody: Column) -> Column:
    return F.when(_lookup(risk, RISK, 0) >= 10000, "Prescrição").when(days >= 365, "Congestionamento").when(in_custody, "Réu preso").otherwise("Outras")


def level(score: Column) -> Column:
    return _steps(score, LEVELS, "NORMAL")


def boosted(points: Column, how_easy: Column) -> Column:
    return (points * (1.0 + (how_easy - 1) * 0.25)).cast("int")


def priority(risk: Column, days: Column, act: Column, in_custody: Column, crime: Column) -> Column:
    """struct of the scores, ease, goal and executor; the act, its ease and the points are worked out once."""
    told = lambda x: F.struct(
        boosted(x["points"], x["ease"]).alias("score_prioridade"),
        x["points"].alias("score_impacto"),
        x["ease"].alias("facilidade_ato"),
        goal(risk, days, in_custody).alias("meta_principal"),
        x["executor"].alias("executor"),
    )
    points = impact(risk, days, in_custody, crime).alias("points")
    return bound(folded_act(act), lambda low: bound(F.struct(points, ease_of(low).alias("ease"), executor_of(low).alias("executor")), told))


def fallback_priority(risk: Column, days: Column, stored_ease: Column, in_custody: Column, crime: Column) -> Column:
    """struct<score, meta> by the stored ease, 3 where there is none; the custody flag as it stands."""
    points = impact(risk, days, F.coalesce(in_custody, F.lit(False)), crime)
    return F.struct(boosted(points, F.coalesce(stored_ease, F.lit(3))).alias("score"), goal(risk, days, F.coalesce(in_custody, F.lit(False))).alias("meta"))


def parsed_days(text: Column) -> Column:
    """Days from text: digits with any hyphens ignored in the test, else 0."""
    return F.when(F.regexp_replace(filled(text), "-", "").rlike(r"^\d+$"), F.coalesce(text.try_cast("int"), F.lit(0))).otherwise(0)


def parsed_flag(text: Column) -> Column:
    return F.coalesce(F.lower(text).isin("true", "sim", "s", "1"), F.lit(False))


def custody_text(in_custody: Column) -> Column:
    return F.when(in_custody, "SIM").otherwise("NÃO")


def ease_text(value: Column) -> Column:
    """The display name of an ease; what is no number shows as 3, an unknown number as itself."""
    # Display names of ease.
    names = {5: "5-Trivial", 4: "4-Simples", 3: "3-Médio", 2: "2-Complexo", 1: "1-Pesado"}
    text = value.cast("string")
    number = F.when(text.rlike(r"^\d+$"), text.try_cast("int")).otherwise(3)
    return F.coalesce(_lookup(number, names, None), text)


# Years after which a penalty of up to so many years lapses, by the maximum penalty.
LIMITATION = [(12, 20), (8, 16), (4, 12), (2, 8), (1, 4)]
SHORTEST_LIMITATION = 3


def limitation_years(maximum_penalty: Column) -> Column:
    """Years of limitation of a crime by its maximum penalty in years; null without one."""
    return F.when(maximum_penalty.isNotNull(), _steps(maximum_penalty, LIMITATION, SHORTEST_LIMITATION))


def workers(sizes: list[int], hint: int = 0, cpus: int = 4) -> int:
    """Extraction workers for files of these bytes: the hint up to 16, else by mean size and half the processors."""
    if hint > 0:
        return max(1, min(hint, 16, len(sizes)))
    if not sizes:
        return 1
    mean = sum(sizes) / len(sizes) / 2**20
    return max(1, min(cpus // 2, 2 if mean > 50 else 3 if mean > 20 else 4, len(sizes)))
