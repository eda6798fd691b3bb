"""Pages to pieces: ordered fold, page ranges, events and status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, fixed_values as V
from ..functions.regex import strip
from ..functions.text import clean_text, cover_metadata, dates, decision_snippet, doc_id, filled, first_line, head_dates, movements

STATE = "cast(array() as array<struct<tipo:string,pag_ini:int,pag_fim:int,head:string,pages:array<int>,ids:array<struct<num:string,pag:string>>,confianca:double>>)"


def page_pieces(pages: DataFrame, text: str = "text") -> DataFrame:
    """pages (numero, pag, text) to typed pages: identifier, clean text of 30 characters and more, type.

    A confirmed cover on page 1 goes, so do types that are dropped; a full type of low confidence is DOC.
    """
    # Each inline() is a barrier: what it makes is worked out once for all later uses and filters.
    t = F.col(text)
    first = F.struct(classify.cover(t)["is_cover"].alias("cover"), doc_id(t).alias("doc_id"), clean_text(t).alias("texto"))
    rows = pages.select("numero", "pag", F.inline(F.array(first)))
    rows = rows.filter(~((F.col("pag") == 1) & F.col("cover")) & (F.length("texto") >= 30))
    kind = F.transform(F.array(classify.classify(F.col("texto"))), lambda p: F.struct(classify.accepted_type(p).alias("tipo"), p["confianca"].alias("confianca")))
    rows = rows.select("numero", "pag", "texto", "doc_id", F.inline(kind))
    return rows.filter(~F.col("tipo").isin(V.DROPPED_PIECES)).select("numero", "pag", "tipo", "texto", "doc_id", "confianca")


def continues(last: Column, page: Column) -> Column:
    """Same type, a gap of at most one page, and the page's identifier is one of the group's."""
    known = F.exists(last["ids"], lambda i: i["num"] == page["doc_id"]["num"])
    return (last["tipo"] == page["tipo"]) & (page["pag"] - last["pag_fim"] <= 1) & F.coalesce(known, F.lit(False))


def belongs(last: Column, page: Column) -> Column:
    """The grouping rules in order: gap, foreign identifier, same type without disjoint dates, DOC after a full piece."""
    near = page["pag"] - last["pag_fim"] <= 1
    foreign = (F.size(last["ids"]) > 0) & page["doc_id"].isNotNull() & ~F.exists(last["ids"], lambda i: i["num"] == page["doc_id"]["num"])
    a, b = head_dates(last["head"]), head_dates(page["head"])
    disjoint = (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)
    same = last["tipo"] == page["tipo"]
    return near & ~F.coalesce(foreign, F.lit(False)) & F.when(same, ~disjoint).otherwise((page["tipo"] == "DOC") & last["tipo"].isin(V.FULL_PIECES))


def fold_pages(pages: DataFrame) -> DataFrame:
    """Typed pages of each case folded in page order into pieces: tipo, pag_ini, pag_fim, texto, doc_ids, confianca, ordem.

    The fold carries only what its tests read: the last piece's type, pages, identifiers, and the first 1500
    characters of its text. Full texts are joined on afterwards.
    """
    key = pages.groupBy("numero").agg(F.array_sort(F.collect_list(F.struct("pag", "tipo", F.substring("texto", 1, 1500).alias("head"), "doc_id", "confianca"))).alias("p"))

    def step(acc: Column, p: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joins = F.coalesce(continues(last, p) | belongs(last, p), F.lit(False))
        new_id = p["doc_id"].isNotNull() & ~F.exists(last["ids"], lambda i: (i["num"] == p["doc_id"]["num"]) & (i["pag"] == p["doc_id"]["pag"]))
        merged = F.struct(
            last["tipo"].alias("tipo"),
            last["pag_ini"].alias("pag_ini"),
            p["pag"].cast("int").alias("pag_fim"),
            F.substring(F.concat(last["head"], F.lit("\n\n"), p["head"]), 1, 1500).alias("head"),
            F.concat(last["pages"], F.array(p["pag"].cast("int"))).alias("pages"),
            F.when(new_id, F.concat(last["ids"], F.array(p["doc_id"]))).otherwise(last["ids"]).alias("ids"),
            F.least(last["confianca"], p["confianca"]).alias("confianca"),
        )
        none = F.expr("cast(array() as array<struct<num:string,pag:string>>)")
        fresh = F.struct(
            p["tipo"].alias("tipo"),
            p["pag"].cast("int").alias("pag_ini"),
            p["pag"].cast("int").alias("pag_fim"),
            p["head"].alias("head"),
            F.array(p["pag"].cast("int")).alias("pages"),
            F.when(p["doc_id"].isNotNull(), F.array(p["doc_id"])).otherwise(none).alias("ids"),
            p["confianca"].alias("confianca"),
        )
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(merged))).otherwise(F.concat(acc, F.array(fresh)))

    groups = key.select("numero", F.posexplode(F.aggregate("p", F.expr(STATE), step)).alias("ordem", "g"))
    spread = groups.select("numero", "ordem", "g.tipo", "g.pag_ini", "g.pag_fim", F.col("g.ids").alias("doc_ids"), "g.confianca", F.explode("g.pages").alias("pag"))
    texts = spread.join(pages.select("numero", "pag", "texto"), ["numero", "pag"])
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pag", "texto"))), lambda x: x["texto"]), "\n\n")
    return texts.groupBy("numero", "ordem").agg(
        F.first("tipo").alias("tipo"), F.first("pag_ini").alias("pag_ini"), F.first("pag_fim").alias("pag_fim"), whole.alias("texto"), F.first("doc_ids").alias("doc_ids"), F.first("confianca").alias("confianca")
    )


def page_ranges(ids: Column) -> Column:
    """array<struct<num, pag>> as `Num. n (p.1-3,7), …`: numbers as first seen, pages sorted, runs joined."""
    nums = F.array_distinct(F.transform(ids, lambda x: x["num"]))

    def runs(num: Column) -> Column:
        mine = F.filter(ids, lambda x: (x["num"] == num) & x["pag"].try_cast("int").isNotNull())
        pages = F.array_sort(F.array_distinct(F.transform(mine, lambda x: x["pag"].try_cast("int"))))
        start = F.expr("cast(array() as array<struct<a:int,b:int>>)")

        def step(acc: Column, p: Column) -> Column:
            last = F.try_element_at(acc, F.lit(-1))
            follows = F.coalesce(last["b"] + 1 == p, F.lit(False))
            longer = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["a"].alias("a"), p.alias("b"))))
            return F.when(follows, longer).otherwise(F.concat(acc, F.array(F.struct(p.alias("a"), p.alias("b")))))

        text = F.array_join(F.transform(F.aggregate(pages, start, step), lambda r: F.when(r["a"] == r["b"], r["a"].cast("string")).otherwise(F.concat_ws("-", r["a"].cast("string"), r["b"].cast("string")))), ",")
        return F.when(F.size(pages) > 0, F.concat(F.lit("Num. "), num, F.lit(" (p."), text, F.lit(")")))

    return F.array_join(F.filter(F.transform(nums, runs), lambda x: x.isNotNull()), ", ")


def covers(pages: DataFrame, text: str = "text") -> DataFrame:
    """numero, meta, movimentos, n_paginas: fields and movements of a first page that is a cover or nearly one."""
    t = filled(F.col(text))
    first = F.when(F.col("pag") == 1, F.struct(classify.cover(t).alias("c"), cover_metadata(t).alias("meta"), movements(t).alias("mov")))
    rows = pages.groupBy("numero").agg(F.count("*").alias("n_paginas"), F.max_by(first, -F.col("pag")).alias("f"))
    known = F.coalesce(F.col("f.c.is_cover") | F.col("f.c.grey"), F.lit(False))
    return rows.select("numero", F.when(known, F.col("f.meta")).alias("meta"), F.when(known, F.col("f.mov")).alias("movimentos"), "n_paginas")


def case_events(pieces: DataFrame) -> DataFrame:
    """Per case the event flags and the timeline of its tracked pieces in page order."""
    page = F.when(F.col("pag_ini") == F.col("pag_fim"), F.col("pag_ini").cast("string")).otherwise(F.concat_ws("-", F.col("pag_ini").cast("string"), F.col("pag_fim").cast("string")))
    event = F.struct(
        F.col("ordem").alias("ordem"),
        F.col("tipo").alias("tipo"),
        page.alias("pagina"),
        F.col("doc_ids").alias("doc_ids"),
        F.get(dates(F.substring("texto", 1, 5000)), F.lit(0)).alias("data_detectada"),
        decision_snippet(F.col("texto")).alias("trecho"),
    )
    tracked = F.col("tipo").isin([t for t, _ in V.EVENT_FLAGS])
    flags = [F.bool_or(F.col("tipo") == t).alias(name) for t, name in V.EVENT_FLAGS]
    return pieces.groupBy("numero").agg(*flags, F.array_sort(F.collect_list(F.when(tracked, event))).alias("eventos"))


# The two ladders, each the first that holds.
PHASES = [
    (["tem_transito_julgado"], "Sentenciado com trânsito em julgado"),
    (["tem_extincao_punibilidade", "tem_cumprimento_sursis", "tem_cumprimento_anpp"], "Punibilidade extinta"),
    (["tem_sentenca"], "Sentenciado, recurso/trânsito pendente"),
    (["tem_revogacao"], "Cautelares revogadas"),
    (["tem_preventiva_decretada"], "Réu preso preventivamente"),
    (["tem_cautelar_319", "tem_liberdade_provisoria"], "Em liberdade com cautelar ativa"),
    (["tem_audiencia_custodia"], "Pós-flagrante (custódia realizada)"),
]
NO_PHASE = "Sem eventos de cautelar identificados"
STATUSES = [
    (["tem_extincao_punibilidade", "tem_transito_julgado"], "EXTINTA (cessou com sentença/extinção)"),
    (["tem_cumprimento_sursis", "tem_cumprimento_anpp"], "EXTINTA (sursis/ANPP cumprido)"),
    (["tem_revogacao"], "REVOGADA"),
    (["tem_preventiva_decretada"], "CONVERTIDA EM PREVENTIVA"),
    (["tem_cautelar_319", "tem_liberdade_provisoria"], "PROVAVELMENTE ATIVA"),
    (["tem_sursis_processual", "tem_anpp"], "VERIFICAR (sursis/ANPP — pode ter cumprido)"),
]
NO_STATUS = "SEM CAUTELAR DETECTADA"


def _ladder(rungs: list[tuple[list[str], str]], other: str) -> Column:
    return reduce(lambda acc, r: F.when(reduce(lambda a, b: a | b, [F.col(c) for c in r[0]]), r[1]).otherwise(acc), reversed(rungs), F.lit(other))


def phase() -> Column:
    return _ladder(PHASES, NO_PHASE)


def status() -> Column:
    return _ladder(STATUSES, NO_STATUS)


def case_flags(events: DataFrame) -> DataFrame:
    return events.withColumns({"fase_aparente": phase(), "provavel_status_cautelar": status()})


def extraction_metrics(pieces: DataFrame) -> DataFrame:
    """Per case: pieces by category and by confidence."""
    c, t = F.col("confianca"), F.col("tipo")
    return pieces.groupBy("numero").agg(
        F.count("*").alias("pecas"),
        F.count_if(t.isin(V.FULL_PIECES)).alias("completas"),
        F.count_if(t.isin(V.SUMMARY_PIECES)).alias("resumo"),
        F.count_if(~t.isin(V.FULL_PIECES + V.SUMMARY_PIECES)).alias("outras"),
        F.count_if(c >= 0.7).alias("confianca_alta"),
        F.count_if((c >= 0.4) & (c < 0.7)).alias("confianca_media"),
        F.count_if(c < 0.4).alias("confianca_baixa"),
    )


# Labels of the rendered text, in their order.
COVER_LABELS = [
    ("classe", "**Classe:** "),
    ("assunto", "**Assunto:** "),
    ("orgao", "**Órgão julgador:** "),
    ("valor", "**Valor da causa:** R$ "),
    ("distribuicao", "**Distribuição:** "),
    ("exequente", "**Autor/Exequente:** "),
    ("executado", "**Réu/Executado:** "),
]
FLAG_LABELS = [
    ("Audiência de custódia", "tem_audiencia_custodia"),
    ("Liberdade provisória", "tem_liberdade_provisoria"),
    ("Cautelar Art. 319", "tem_cautelar_319"),
    ("Termo de compromisso", "tem_termo_compromisso"),
    ("Sursis processual", "tem_sursis_processual"),
    ("ANPP", "tem_anpp"),
    ("Transação penal", "tem_transacao_penal"),
    ("Revogação de cautelar", "tem_revogacao"),
    ("Preventiva decretada", "tem_preventiva_decretada"),
    ("Sentença", "tem_sentenca"),
    ("Trânsito em julgado", "tem_transito_julgado"),
    ("Extinção da punibilidade", "tem_extincao_punibilidade"),
]
PEOPLE_LABELS = [("cpfs", "CPFs", 10), ("rgs", "RGs", 5), ("telefones", "Telefones", 5), ("ceps", "CEPs", 5), ("datas", "Datas", 10)]
MOVEMENT_HEAD = ["## MOVIMENTAÇÃO PROCESSUAL", "", "| Data | Descrição |", "|------|-----------|"]
FLAGS_HEAD = ["## SINALIZADORES PROCESSUAIS (extração automática)", ""]
PEOPLE_HEAD = ["## DADOS PESSOAIS DETECTADOS (extração automática)", ""]
PEOPLE_NOTE = "> Verificar papel processual (réu/vítima/testemunha) antes de cadastrar."
#: Confidence below which a full piece says so.
UNSURE = 0.5


def _lines(*lines: str | Column) -> Column:
    """An array of lines; null ones go."""
    return F.filter(F.array(*[F.lit(x) if isinstance(x, str) else x for x in lines]), lambda x: x.isNotNull())


def _given(values: Column, prefix: str) -> Column:
    """prefix and the text, or null where there is none."""
    return F.when(F.coalesce(values, F.lit("")) != "", F.concat(F.lit(prefix), values))


def _span(x: Column) -> Column:
    first, last = x["pag_ini"].cast("string"), x["pag_fim"].cast("string")
    return F.when(x["pag_ini"] == x["pag_fim"], F.concat(F.lit("p."), first)).otherwise(F.concat(F.lit("p."), first, F.lit("-"), last))


def _full_piece(x: Column) -> Column:
    ids = page_ranges(x["doc_ids"])
    unsure = F.when(x["confianca"] < UNSURE, F.format_string("  <!-- confiança: %.0f%% -->", F.bround(x["confianca"] * 100, 0))).otherwise("")
    head = F.concat(F.lit("## "), x["tipo"], F.lit(" ("), _span(x), F.lit(")"), F.when(ids != "", F.concat(F.lit(" — "), ids)).otherwise(""), unsure)
    return _lines(head, "", x["texto"], "")


def _short_piece(x: Column) -> Column:
    ids = page_ranges(x["doc_ids"])
    return F.concat(F.lit("- **"), x["tipo"], F.lit("** "), _span(x), F.when(ids != "", F.concat(F.lit(" ["), ids, F.lit("]"))).otherwise(""), F.lit(": "), first_line(x["texto"]))


def _event(e: Column) -> Column:
    ids = page_ranges(e["doc_ids"])
    ids = F.when(ids != "", F.concat(F.lit(" ["), ids, F.lit("]"))).otherwise("")
    return F.concat(F.lit("  - "), e["tipo"], F.lit(" (p."), e["pagina"], ids, F.lit(")"), F.coalesce(F.concat(F.lit(" em "), e["data_detectada"]), F.lit("")))


def render_case(pieces: DataFrame, flags: DataFrame, covers: DataFrame, people: DataFrame) -> DataFrame:
    """Per case one markdown text: cover, movements, flags and timeline, personal data, full pieces, list of the others.

    covers: numero, meta (the cover's fields), movimentos, n_paginas; people: numero, dados_pessoais.
    """
    rows = F.array_sort(F.collect_list(F.struct("ordem", "tipo", "pag_ini", "pag_fim", "doc_ids", "texto", "confianca")))
    cases = pieces.groupBy("numero").agg(rows.alias("p")).join(covers, "numero", "full").join(flags, "numero", "left").join(people, "numero", "left")
    cases = cases.withColumn("p", F.coalesce("p", F.expr("cast(array() as array<struct<ordem:int,tipo:string,pag_ini:int,pag_fim:int,doc_ids:array<struct<num:string,pag:string>>,texto:string,confianca:double>>)")))
    full, short = F.filter("p", lambda x: x["tipo"].isin(V.FULL_PIECES)), F.filter("p", lambda x: x["tipo"].isin(V.SUMMARY_PIECES))
    head = _lines(
        *[_given(F.col(f"meta.{name}"), label) for name, label in COVER_LABELS],
        F.concat(F.lit("**Total de páginas:** "), F.coalesce("n_paginas", F.lit(0)).cast("string")),
        F.concat(F.lit("**Peças identificadas:** "), (F.size(full) + F.size(short)).cast("string")),
    )
    none = F.expr("cast(array() as array<string>)")
    moved = F.transform("movimentos", lambda m: F.concat(F.lit("| "), m["data"], F.lit(" | "), m["descricao"], F.lit(" |")))
    detected = F.array_join(_lines(*[F.when(F.col(c), label) for label, c in FLAG_LABELS]), ", ")
    events = F.coalesce(F.transform("eventos", _event), none)
    told = _lines(*[_given(F.array_join(F.slice(f"dados_pessoais.{c}", 1, n), ", "), f"- **{label}**: ") for c, label, n in PEOPLE_LABELS])
    parts = F.concat(
        _lines(F.concat(F.lit("# "), "numero"), "", F.array_join(head, "  \n"), "", "---", ""),
        F.when(F.size("movimentos") > 0, F.concat(_lines(*MOVEMENT_HEAD), moved, _lines(""))).otherwise(none),
        _lines(
            *FLAGS_HEAD,
            F.concat(F.lit("- **Fase aparente**: "), F.coalesce("fase_aparente", F.lit(NO_PHASE))),
            F.concat(F.lit("- **Provável status da cautelar**: "), F.coalesce("provavel_status_cautelar", F.lit(NO_STATUS))),
            _given(detected, "- **Eventos detectados**: "),
            F.when(F.size(events) > 0, "- **Linha do tempo**:"),
        ),
        events,
        _lines(""),
        F.when(F.size(told) > 0, F.concat(_lines(*PEOPLE_HEAD), told, _lines("", PEOPLE_NOTE, ""))).otherwise(none),
        F.flatten(F.transform(full, _full_piece)),
        F.when(F.size(short) > 0, F.concat(_lines("## Peças Secundárias", ""), F.transform(short, _short_piece), _lines(""))).otherwise(none),
    )
    return cases.select("numero", F.concat(strip(F.array_join(parts, "\n")), F.lit("\n")).alias("markdown"))


def changed_only(rendered: DataFrame, earlier: DataFrame) -> DataFrame:
    """Rows of rendered (numero, markdown) whose digest differs from that of earlier (numero, md5)."""
    now = rendered.withColumn("md5", F.md5("markdown"))
    return now.join(earlier.select("numero", F.col("md5").alias("_old")), "numero", "left").filter(~F.col("md5").eqNullSafe(F.col("_old"))).drop("_old")
