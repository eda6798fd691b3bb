"""The assertions of the domain, as rows through the operators."""

import re

import pytest
from pyspark.sql import functions as F

from docketmill.functions import classify, fixed_values as V, quality, scoring, text as T
from docketmill.functions.regex import java, needed


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("x")).first().x


def texts(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def test_pattern_flags():
    assert java(r"a\Z", "i") == r"(?uUdi)a\z"


def test_classifier_labels(spark):
    got = texts(
        spark,
        [
            "O Ministério Público oferece a presente denúncia",
            "Pelo exposto, julgo procedente o pedido e condeno o réu",
            "cumprido o período de prova, art. 89, § 5º, declaro extinta a punibilidade",
            "declaro extinta a punibilidade, art. 107 do CP",
            "termo de declarações. às perguntas do(a) delegado respondeu",
            "nada aqui",
            "",
            None,
            "oferece a presente denúncia como autor. " + "texto sem sinal. " * 400,
            "texto sem sinal algum. " * 140 + "julgo procedente o pedido. condeno o réu.",
        ],
        classify.classify(F.col("t")),
    )
    assert [g.tipo for g in got] == ["DENÚNCIA", "SENTENÇA", "CUMPRIMENTO_SURSIS", "EXTINCAO_PUNIBILIDADE", "DECLARAÇÃO", "DOC", "DOC", "DOC", "DENÚNCIA", "SENTENÇA"]
    assert (got[5].score, got[5].confianca) == (0, 0.0)


def test_classifier_floor(spark):
    (got,) = texts(spark, ["alvará de soltura"], classify.classify(F.col("t"), least=100))
    assert got.tipo == "DOC" and got.score == 20


def python_classify(text):
    def scores(sample, bonus):
        out = {}
        for name, least, signals in V.PIECE_RULES:
            s = 0
            for p, f, w in signals:
                rx = re.compile(p, sum({"i": re.I, "m": re.M, "s": re.S}[c] for c in f))
                if rx.search(sample):
                    s += w + (w if bonus and rx.search(sample[:400]) else 0)
            if s >= least:
                out[name] = s
        return out

    if not text:
        return "DOC", 0
    if len(text) <= 3000:
        total = scores(text, True)
    else:
        total, at = {}, 0
        while True:
            for k, v in scores(text[at : at + 3000], at == 0).items():
                total[k] = total.get(k, 0) + v * (1.5 if at == 0 else 1.0)
            if at + 3000 >= len(text):
                break
            at += 1500
        total = total or scores(text[:6000], True)
    if not total:
        return "DOC", 0
    best = max(total, key=total.get)
    return best, round(total[best])


def test_classifier_against_plain_python(spark):
    import random

    rng = random.Random(3)
    parts = ["vistos, etc. ", "cite-se. ", "certifico que ", "ata de audiência ", "boletim de ocorrência ", "palavra comum " * 30, "\nDECISÃO\n", "anpp ", "laudo de exame ", "apelação "]
    samples = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(25)]
    got = texts(spark, samples, classify.classify(F.col("t")))
    assert [(g.tipo, g.score) for g in got] == [python_classify(s) for s in samples]


@pytest.mark.parametrize("best, second, want", [(30, 0, 1.0), (20, 10, 0.608), (0, 0, 0.0)])
def test_confidence(spark, best, second, want):
    assert one(spark, classify.confidence(F.col("a"), F.col("b")), a=best, b=second) == want


@pytest.mark.parametrize("n, want", [(10, 1), (3000, 1), (3001, 2), (4500, 2), (4501, 3)])
def test_windows(spark, n, want):
    assert one(spark, F.size(classify.windows(F.col("t"))), t="x" * n) == want


def test_category_sets_are_disjoint():
    assert not set(V.FULL_PIECES) & set(V.SUMMARY_PIECES) and not set(V.FULL_PIECES) & set(V.DROPPED_PIECES)
    assert len(V.PIECE_RULES) == 41 and sum(len(r[2]) for r in V.PIECE_RULES) == 114


def test_cleaning(spark):
    got = texts(
        spark,
        [None, "", "a\n\n\n\nb  \nc", "ver https://x.y/z agora", "Num. 123456 - Pág. 2\ncorpo", "1234567890123\ncorpo", "Impresso por: fulano\ncorpo", "Pg. 3/10 corpo", "![i](u) corpo"],
        T.clean_text(F.col("t")),
    )
    assert got == ["", "", "a\n\nb\nc", "ver  agora", "corpo", "corpo", "corpo", "corpo", "corpo"]


def test_removal_log(spark):
    (log,) = texts(spark, ["ver https://a.b e https://c.d fim"], T.removal_log(F.col("t")))
    assert [(x.rule, x.snippet, x.start) for x in log] == [("url", "https://a.b", 4), ("url", "https://c.d", 18)]


def test_doc_id(spark):
    got = texts(spark, ["Num. 11111 - Pág. 1 x Num. 22222 - Pág. 7", "Id 33333 solto", "sem", None], T.doc_id(F.col("t")))
    assert [(g.num, g.pag) if g else None for g in got] == [("22222", "7"), ("33333", "1"), None, None]


def test_poor_text(spark):
    good = "palavras comuns de um texto legível e bastante longo para passar por todas as provas de qualidade deste exame simples"
    got = texts(spark, ["", "oi", "∞È" * 60, "1 2 3 " * 40, good], quality.poor_text(F.col("t")))
    assert [g.poor for g in got] == [True, True, True, True, False]


def test_better_text(spark):
    assert one(spark, quality.better_text(F.lit(""), F.col("t")), t="abc") == "abc"
    assert one(spark, quality.better_text(F.col("t"), F.lit("  ")), t="abc") == "abc"


def test_cover(spark):
    got = texts(spark, ["PJe - Processo Judicial\nÓrgão julgador: 1ª Vara\nClasse: Ação\nAssunto: Furto", "Classe: Ação", "PJe - Processo Judicial"], classify.cover(F.col("t")))
    assert [(g.is_cover, g.grey) for g in got] == [(True, False), (False, False), (False, True)]


@pytest.mark.parametrize("value, want", [("12345678901", "123.456.789-01"), ("123", "123"), (None, "")])
def test_cpf(spark, value, want):
    assert texts(spark, [value], T.format_cpf(F.col("t"))) == [want]


@pytest.mark.parametrize("value, want", [("5571999991234", "(71) 99999-1234"), ("7133331234", "(71) 3333-1234"), ("12", "12")])
def test_phone(spark, value, want):
    assert one(spark, T.format_phone(F.col("t")), t=value) == want


@pytest.mark.parametrize("value, want", [("1/2/24", "01/02/2024"), ("10-11-85", "10/11/1985"), ("1.2.1999", "01/02/1999"), ("x", "x")])
def test_date(spark, value, want):
    assert one(spark, T.format_date(F.col("t")), t=value) == want


@pytest.mark.parametrize("value, want", [("BO", "BOLETIM_OCORRENCIA"), ("APF", "AUTO_PRISAO_FLAGRANTE"), ("sentença", "SENTENCA"), ("xyz", "DOC"), ("", "DOC")])
def test_piece_label(spark, value, want):
    assert one(spark, classify.piece_label(F.col("t")), t=value) == want


@pytest.mark.parametrize("value, want", [("", "TCO"), ("APSumss", "APSum"), ("Ação Penal - Procedimento Sumaríssimo", "APSumss"), ("Execução", "Execução")])
def test_class_code(spark, value, want):
    assert one(spark, classify.class_code(F.col("t")), t=value) == want


def test_names(spark):
    assert one(spark, T.title_name(F.col("t")), t="  JOÃO   DA SILVA") == "João da Silva"
    assert one(spark, T.match_name(F.col("t")), t="José da SILVA (réu)") == "da jose silva"
    assert one(spark, T.sheet_key(F.col("t")), t="⭐ Litispendência ") == "litispendencia"


def test_measures(spark):
    (m,) = texts(spark, ["Impõe comparecimento mensal e tornozeleira. Sem fiança."], classify.measures(F.col("t")))
    assert m.comparecimento_mensal and m.monitoracao_eletronica and m.fianca and not m.outras
    assert [s.cautelar for s in m.trechos] == ["comparecimento_mensal", "monitoracao_eletronica", "fianca"]
    (m,) = texts(spark, ["aplico o art. 319 do código"], classify.measures(F.col("t")))
    assert m.outras and m.trechos == []


def test_qualification(spark):
    (q,) = texts(spark, ["Nome: MARIA DE SOUZA\nCPF 12345678901\nMãe: ANA SOUZA\nData de nascimento: 1/2/85\nTel (71) 99999-1234\nProfissão: Pedreiro\n"], T.qualification(F.col("t")))
    assert (q.nome, q.cpf, q.filiacao_mae, q.data_nascimento) == ("Maria de Souza", "123.456.789-01", "Ana Souza", "01/02/1985")
    assert q.telefone == "(12) 34567-8901"  # the first run of digits that fits, here the CPF's


def test_personal_data(spark):
    (d,) = texts(spark, ["CPF 123.456.789-01 e 123.456.789-01, RG: 1234567 SSP, fone (71) 99999-1234, CEP 40000-000, em 1/2/2020 e 01-02-2020"], T.personal_data(F.col("t")))
    assert d.cpfs == ["123.456.789-01"] and d.telefones == ["(71) 99999-1234"] and d.ceps == ["40000-000"] and d.datas == ["1/2/2020", "01/02/2020"]


def test_scoring(spark):
    p = scoring.priority(F.lit("ATENCAO"), F.lit(450), F.lit("minutar sentença"), F.lit(False), F.lit("CRITICA"))
    got = spark.range(1).select(p.alias("p")).first().p
    assert (got.score_impacto, got.facilidade_ato, got.score_prioridade, got.meta_principal, got.executor) == (12800, 1, 12800, "Prescrição", "Assessoria")
    p = scoring.priority(F.lit("SEM RISCO"), F.lit(100), F.lit("intimar delegado"), F.lit(True), F.lit("MEDIA"))
    got = spark.range(1).select(p.alias("p")).first().p
    assert (got.score_impacto, got.facilidade_ato, got.score_prioridade, got.meta_principal, got.executor) == (3700, 5, 7400, "Réu preso", "Cartório")


@pytest.mark.parametrize("days, subject, want", [(800, "roubo", (2300, "CRITICA")), (400, "x", (700, "MEDIA")), (365, "x", (365, "BAIXA"))])
def test_urgency(spark, days, subject, want):
    got = spark.range(1).select(scoring.urgency(F.lit(days), F.lit(subject), F.lit("")).alias("u")).first().u
    assert (got.score, got.urgencia) == want


def test_patterns_are_tried_only_where_all_that_they_need_is_there(spark):
    custody = r"\bart\.?\s*310[\s,]+(?:caput|do cpp|cpp)"
    got = texts(spark, ["art. 310, do cpp", "art 310 caput", "a parte do cpp", "art. 310 do cp", "310 cpp"], needed(F.col("t"), custody))
    assert got == [True, True, False, False, False]
    # Signals that only together, in twice the window from the start, make a type.
    wide = "x " * 225 + "intime-se " + "x " * 1020 + "cumpra-se " + "x " * 1495 + "cite-se" + " x" * 1000
    near = "medidas cautelares diversas" + " x" * 5000 + " auto de " + "y " * 3000
    assert texts(spark, [wide, near], classify.classify(F.col("t"))["tipo"]) == ["DESPACHO", "CAUTELAR_319"]
