"""Folds, queues, groups, linkage and sources, against plain Python where the order matters."""

import random

import pytest
from pyspark.sql import functions as F

from docketmill.operators import consolidate, dedup, groups, linkage, pieces, queues
from docketmill.sources import pages, sinks, tables, workbook

PAGE = "numero string, pag int, tipo string, texto string, doc_id struct<num:string,pag:string>, confianca double"


def fold(spark, rows):
    got = pieces.fold_pages(spark.createDataFrame(rows, PAGE)).orderBy("numero", "ordem").collect()
    return [(r.tipo, r.pag_ini, r.pag_fim, r.texto) for r in got]


def test_fold_by_identifier(spark):
    rows = [("c", p, t, f"t{p}", d and (d, str(p)), 0.5) for p, t, d in ((1, "DENÚNCIA", "11111"), (2, "DENÚNCIA", "11111"), (3, "DOC", None), (4, "DENÚNCIA", "22222"), (7, "DENÚNCIA", "22222"))]
    assert fold(spark, rows) == [("DENÚNCIA", 1, 3, "t1\n\nt2\n\nt3"), ("DENÚNCIA", 4, 4, "t4"), ("DENÚNCIA", 7, 7, "t7")]


def test_fold_by_dates(spark):
    rows = [("c", p, "DECISÃO", t, None, 0.5) for p, t in ((1, "em 01/02/2020"), (2, "em 03/04/2021"), (3, "sem data"))]
    assert [x[:3] for x in fold(spark, rows)] == [("DECISÃO", 1, 1), ("DECISÃO", 2, 3)]


def plain_fold(rows):
    out = []
    for pag, tipo, doc in rows:
        if out:
            last = out[-1]
            gap = pag - last[2]
            own = doc and doc in last[3]
            if gap <= 1 and ((last[0] == tipo and own) or (not (last[3] and doc and not own) and (last[0] == tipo or (tipo == "DOC" and last[0] == "ATA")))):
                last[2] = pag
                if doc and not own:
                    last[3].append(doc)
                continue
        out.append([tipo, pag, pag, [doc] if doc else []])
    return [(a, b, c) for a, b, c, _ in out]


def test_fold_against_plain_python(spark):
    rng = random.Random(5)
    for _ in range(3):
        rows, pag = [], 0
        for _ in range(60):
            pag += rng.choice([1, 1, 1, 2])
            rows.append((pag, rng.choice(["ATA", "DOC", "OFÍCIO"]), rng.choice([None, "1", "2"])))
        got = fold(spark, [("c", p, t, "x", d and (d, "1"), 0.5) for p, t, d in rows])
        assert [x[:3] for x in got] == plain_fold(rows)


def test_page_ranges(spark):
    df = spark.createDataFrame([([("111", "3"), ("111", "1"), ("222", "5"), ("111", "2"), ("111", "7"), ("333", "x")],), ([],)], "ids array<struct<num:string,pag:string>>")
    assert [r[0] for r in df.select(pieces.page_ranges(F.col("ids"))).collect()] == ["Num. 111 (p.1-3,7), Num. 222 (p.5)", ""]


def test_adaptive_packing(spark):
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate([2, 3, 2, 7, 4, 2, 5])], "g int, o long, n int")
    got = queues.adaptive_packing(df, ["g"], "o", "n").orderBy("o").collect()
    assert [r.num for r in got] == [1, 1, 2, 3, 4, 4, 5]


def test_global_rank(spark):
    df = spark.createDataFrame([(i % 3, (i * 7919) % 101, i) for i in range(500)], "g int, v int, i int")
    got = queues.global_rank(df, [F.desc("v"), F.asc("i")], ["g"]).collect()
    want = {}
    for g in range(3):
        for n, r in enumerate(sorted((r for r in got if r.g == g), key=lambda r: (-r.v, r.i)), 1):
            want[r.i] = n
    assert len(got) == 500 and all(want[r.i] == r["rank"] for r in got)


def test_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k string, o int, v string")
    assert {r.k: r.v for r in dedup.first_wins(df, ["k"], ["o"]).collect()} == {"a": "y", "b": None}
    assert {r.k: r.v for r in dedup.last_wins(df, ["k"], ["o"]).collect()} == {"a": "x", "b": None}


def test_batches_run_on(spark):
    df = spark.createDataFrame([(i, "AB"[i % 2], i, i < 8) for i in range(40)], "k int, prompt string, score int, tem boolean")
    got = queues.fixed_batches(df, "prompt", [F.desc("score"), F.asc("k")], "tem").orderBy("num", "place").collect()
    sizes = {}
    for r in got:
        sizes.setdefault((r.num, r.tem, r.prompt), []).append(r.k)
    assert [len(v) for _, v in sorted(sizes.items())] == [3, 1, 3, 1, 15, 1, 15, 1]


def test_fixed_batches_equal_their_sql_on_halves_and_nulls(spark, tmp_path):
    """The SQL's cast takes halves to the even number; null groups come last and keep their rows."""
    import duckdb

    from docketmill.plans import catalogue

    rows = [(k, [None, "A", "B"][k % 3], 100.0 + (k * 7 % 40) / 2) for k in range(200)] + [(None, "A", 100.5), (None, None, 101.5)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderpriority string, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    got = catalogue.QUERIES["fixed_batches"](spark, str(tmp_path)).collect()
    base = duckdb.connect()
    base.execute(f"CREATE VIEW orders AS FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert {tuple(r) for r in got} == set(base.execute(catalogue.SQL["fixed_batches"]).fetchall())


def book():
    cases = [f"{i:07d}-01.2020.8.05.0001" for i in range(6)]
    head = ["Grupo", "Polo Ativo", "Polo Passivo", "Classe", "Assunto", "Nº Processo", "Status"]
    body = [["Grupo 10", "A", "B", "C1", "S", cases[0], "ATIVO"], ["Grupo 10", "A2", "B", "C1", "S", cases[1], "ATIVO"], ["Grupo 2", "X", "", "C2", "S", cases[2], "ATIVO"], ["Grupo 2", "X", "", "C3", "S", f"n. {cases[3]}", "FIM"], ["Grupo 3", "só", "um", "C", "S", cases[4], "ATIVO"], [None, None, None, None, None, cases[5], None]]
    return workbook.write_workbook({"Litispendência": (["Título"], [head, *body])}), cases


def test_workbook_groups(spark, tmp_path):
    data, cases = book()
    (tmp_path / "w.xlsx").write_bytes(data)
    rows = workbook.read_workbook(spark, str(tmp_path / "w.xlsx"))
    got = groups.case_groups(rows, ["⭐ Litispendência", "Nenhuma"]).orderBy("group_id").collect()
    assert [(r.group_id, r.grupo_planilha, r.processos) for r in got] == [("lit_001", "Grupo 2", cases[2:4]), ("lit_002", "Grupo 10", cases[:2])]
    assert got[0].classe_amostra == "C2; C3" and got[1].partes_amostra == "A ↔ A2 vs B"


def test_similarity():
    assert linkage.similarity("abc", "abc") == 100.0 and linkage.similarity("", "") == 100.0 and linkage.similarity("a", "b") == 0.0
    rng = random.Random(2)
    for _ in range(100):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert linkage.common_subsequence(a, b) == t[-1][-1]


def test_linkage(spark):
    n = "0000001-01.2020.8.05.0001"
    paper = linkage.prepare_paper(spark.createDataFrame([(1, n, "Qualquer Um", "L"), (2, "", "JOSÉ DA SILVA (réu)", "L"), (3, "", "Mario Souza", "L"), (4, "", "zzz", "L"), (5, "", " ", "L")], "idx long, processo string, nome string, livro string"))
    reg = linkage.prepare_registry(spark.createDataFrame([(1, "i1", n, "Outro Nome"), (2, "i2", n, "Qualquer Umm"), (3, "i3", "p", "Silva da José"), (4, "i4", "q", "Maria Souza"), (5, "i5", "q", "")], "pos long, id string, processo string, nome string"))
    got = {r.idx: (r.metodo, r.pje_id_processo, r.revisar) for r in linkage.link(paper, reg).collect()}
    assert got == {1: ("cnj", "i2", False), 2: ("exato", "i3", False), 3: ("fuzzy", "i4", False), 4: ("sem_match", None, True)}


def test_json_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"numero": "1", "v": "x"}, {"numero": "2", "v": "y"}]')
    (tmp_path / "b.json").write_text('{"numero": "1", "v": "z"}')
    (tmp_path / "c.json").write_text("{broken")
    rows = tables.json_rows(spark, str(tmp_path), "numero string, v string")
    assert rows.count() == 3
    assert {r.numero: r.v for r in tables.first_records(rows, "numero").collect()} == {"1": "x", "2": "y"}
    assert tables.json_rows(spark, str(tmp_path / "none"), "numero string").count() == 0


def test_case_table(spark, tmp_path):
    (tmp_path / "c.csv").write_text("﻿Número do Processo,Classe\n 1 ,A\n1,B\n,C\n", encoding="utf-8")
    got = tables.case_table(spark, str(tmp_path / "c.csv")).collect()
    assert [(r[0], r["Classe"]) for r in got] == [("1", "A")]


def test_status_markdown(spark, tmp_path):
    (tmp_path / "a.md").write_text("# 123\n**Status:** PROVAVELMENTE ATIVA\n")
    (tmp_path / "b.md").write_text("sem título\n**Status:** X\n")
    rows = tables.status_markdown(spark, str(tmp_path))
    assert [r.numero_processo for r in tables.eligible(rows).collect()] == ["123"]


def test_command_blocks(spark):
    blocks = tables.command_blocks(spark.createDataFrame([("x\n# === CMD 2 ===\na\n# === CMD 1 ===\nb",)], "text string"))
    assert [(r.pos, r.num) for r in blocks.orderBy("pos").collect()] == [(0, 2), (1, 1)]
    got = tables.blocks_of(spark.createDataFrame([(1, 0), (9, 0)], "num int, pos int"), blocks).orderBy("num").collect()
    assert "b" in got[0].bloco and "a" in got[1].bloco


def test_pages_hook(spark):
    files = spark.createDataFrame([("f", bytearray(b"one\x0ctwo")), ("g", bytearray(b"bad"))], "path string, content binary")

    def extractor(path, content, plain):
        if path == "g":
            raise ValueError("broken")
        return content.decode().split("\f")

    got = pages.extract_pages(files, extractor, pause=0).orderBy("path", "pag").collect()
    assert [(r.path, r.pag, r.text, r.error) for r in got] == [("f", 1, "one", None), ("f", 2, "two", None), ("g", None, None, "broken")]


def test_imaging():
    import numpy as np

    image = np.full((20, 20), 200, np.uint8)
    image[5:8] = 20
    assert pages.binarize(image)[6, 3] == 0 and pages.binarize(image)[0, 0] == 255
    assert pages.best_reading([3, 6, 4], lambda m: str(m), lambda t: 0.9 if t == "6" else 0.1) == "6"


def test_flatten_and_pairs(spark):
    df = spark.createDataFrame([("g", [(["1", "2", "3", "4"], "t", "j")]), ("h", None)], "group_id string, pares_litispendencia array<struct<processos:array<string>,tipo:string,justificativa:string>>")
    assert [(r.processo_a, r.processo_b, r.outros) for r in consolidate.pair_rows(df).collect()] == [("1", "2", "3, 4")]
    df = spark.createDataFrame([((1, ("x",)), [1, 2])], "a struct<b:int,c:struct<d:string>>, l array<int>")
    flat = consolidate.flatten(df)
    assert flat.columns == ["a.b", "a.c.d", "l"] and tuple(flat.first()) == (1, "x", "1; 2")


def test_statistics_count_missing_lists(spark):
    df = spark.createDataFrame([("LITISPENDENCIA_TOTAL", "ALTA", "ALTA", "x", ["p"], None, None)], "classificacao_final string, prioridade string, confianca string, aba_origem string, pares_litispendencia array<string>, processos_distintos array<string>, processos_coisa_julgada array<string>")
    got = consolidate.statistics(df)
    assert tuple(got["totais"].first()) == (1, 1, 0, 0) and got["classificacao"].count() == 7


def test_workbook_sink(spark):
    data = sinks.workbook_of({"S": spark.createDataFrame([(1, "a&b"), (2, None)], "n int, t string")})
    assert list(workbook.parse(data)) == [("S", 1, ["n", "t"]), ("S", 2, ["1", "a&b"]), ("S", 3, ["2"])]


def test_incremental(spark, tmp_path):
    from docketmill.streaming.incremental import read_state, run_incremental

    folder, state = tmp_path / "in", tmp_path / "state"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(b"1")
    work = lambda rows: rows.select("numero", F.length("content").alias("n"))
    run_incremental(spark, str(folder), str(state), "v1", work)
    (folder / "b.pdf").write_bytes(b"22")
    run_incremental(spark, str(folder), str(state), "v1", work)
    assert {r.numero: r.n for r in read_state(spark, str(state), "results").collect()} == {"a": 1, "b": 2}


def test_pending_split(spark):
    f = spark.createDataFrame([("a", "k1"), ("b", "k2"), ("c", "k3")], "numero string, cache_key string")
    c = spark.createDataFrame([("a", "k1"), ("b", "old"), ("c", "k3")], "numero string, cache_key string")
    o = spark.createDataFrame([("a",), ("b",)], "numero string")
    assert {r.numero: r.hit for r in queues.pending_split(f, c, o).collect()} == {"a": True, "b": False, "c": False}
    assert not any(r.hit for r in queues.pending_split(f, c, o, force=True).collect())


@pytest.mark.parametrize("given, want", [("IP+tco, x", ["IP", "tco", "x"]), (None, [])])
def test_parse_filter(given, want):
    from docketmill.functions.classify import parse_filter

    assert parse_filter(given) == want


def test_image_steps():
    import numpy as np

    from docketmill.sources import pages

    assert (pages.binarize(np.full((4, 4), 50)) == 0).all() and (pages.binarize(np.full((4, 4), 138)) == 255).all()
    assert pages.best_reading(pages.MODES, lambda m: f"junk{m}", lambda t: -0.3) == ""
    assert pages.best_reading((3, 6, 4), str, lambda t: {"3": 0.5, "6": 0.5, "4": 0.2}[t]) == "3"
    image = np.full((200, 300), 255, np.uint8)
    y, x = np.mgrid[:200, :300]
    tilt = np.radians(5)
    image[(np.abs((y - 100) * np.cos(tilt) - (x - 150) * np.sin(tilt)) < 20) & (np.abs((x - 150) * np.cos(tilt) + (y - 100) * np.sin(tilt)) < 100)] = 0
    assert abs(pages.skew_angle(image) - 5) < 0.6
    assert pages.skew_angle(pages.deskew(image)) == 0.0 and (pages.deskew(image) == 0).sum() > 7000
    cache, made = pages.PageCache(4), []
    for k in [1, 2, 3, 4, 1, 5, 1, 4]:
        cache.read(str(k), lambda k=k: made.append(k) or str(k))
    assert made == [1, 2, 3, 4, 5, 1]


def test_log_reset_and_defaults(spark, tmp_path):
    from docketmill.functions import scoring
    from docketmill.operators import queues
    from docketmill.sources import tables

    log = queues.mark_done(spark, 3, ["a", "b"], "r", "2024-01-01").unionByName(queues.mark_done(spark, 4, [], "r", "2024-01-02"))
    state = queues.checkpoint_state(log)
    assert sorted(r.cmd for r in state["comandos_concluidos"].collect()) == [3, 4] and state["ultimo_comando"].first()[0] == 4
    commands = spark.createDataFrame([(3, "a"), (3, "b"), (5, "b"), (5, "c"), (6, "d")], "cmd long, item string")
    got = {r.cmd: (r.total, r.done, r.concluido, r.parcial) for r in queues.command_lists(commands, log).collect()}
    assert got == {3: (2, 2, True, False), 5: (2, 1, False, True), 6: (1, 0, False, False)}
    control = tmp_path / "controle_grupos.json"
    control.write_text('[{"a": 1}]')
    assert [r.a for r in tables.json_or_default(spark, str(control), "a int").collect()] == [1]
    assert queues.reset_control(spark, str(control), "20240101_000000") is None and control.exists()
    assert queues.reset_control(spark, str(control), "20240101_000000", True).endswith("controle_grupos.bkp_20240101_000000.json")
    assert not control.exists() and len(list(tmp_path.glob("*bkp*.json"))) == 1
    default = spark.createDataFrame([(7,)], "a int")
    assert [r.a for r in tables.json_or_default(spark, str(control), "a int", default).collect()] == [7]
    (tmp_path / "broken.json").write_text("{nothing")
    assert [r.file for r in tables.broken_json(spark, str(tmp_path)).collect()] == ["broken.json"]
    assert tables.json_or_default(spark, str(tmp_path / "broken.json"), "a int").count() == 0
    (tmp_path / "queue").mkdir()
    assert queues.reset_queue(spark, [str(tmp_path / "queue"), str(tmp_path / "none")]) == [str(tmp_path / "queue")]
    (tmp_path / "prompt_IP.md").write_text("text of IP")
    assert {r.chave: r.prompt for r in tables.prompts(spark, str(tmp_path)).collect()}["IP"] == "text of IP"
    assert tables.prompts(spark, str(tmp_path / "none")).filter("prompt = ''").count() == 7
    years = spark.createDataFrame([(x,) for x in (0.5, 1.0, 2.0, 3.9, 4.0, 8.0, 12.0, None)], "m double").select(scoring.limitation_years("m" and __import__("pyspark.sql.functions", fromlist=["col"]).col("m")).alias("y"))
    assert [r.y for r in years.collect()] == [3, 4, 8, 8, 12, 16, 20, None]
    assert [scoring.workers(s, h, 8) for s, h in (([], 0), ([1] * 9, 0), ([60 << 20] * 3, 0), ([30 << 20] * 9, 0), ([1] * 40, 20), ([1] * 2, 9))] == [1, 4, 2, 3, 16, 2]


def test_first_wins_follows_file_names(spark, tmp_path):
    from docketmill.sources import tables

    (tmp_path / "b.csv").write_text("Número do Processo,v\nk,from b\n" + "x,y\n" * 5000)
    (tmp_path / "a.csv").write_text("Número do Processo,v\nk,from a\nk,second\n")
    rows = tables.case_table(spark, str(tmp_path))
    assert [r.v for r in rows.collect() if r[0] == "k"] == ["from a"]


def test_readers_and_small_plans(spark, tmp_path):
    from pyspark.sql import functions as F

    from docketmill.functions import classify, quality, scoring, text as T
    from docketmill.operators import consolidate, linkage, queues
    from docketmill.sources import sinks, tables

    (tmp_path / "0001_x.txt").write_text("t")
    (tmp_path / "0002_y.md").write_text("t")
    (tmp_path / "c.pdf").write_bytes(b"%PDF")
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    assert sorted(r.stem for r in tables.text_inventory(spark, str(tmp_path)).collect()) == ["0001_x", "0002_y"]
    assert sorted(r.path.rsplit("/", 1)[-1] for r in tables.files(spark, str(tmp_path)).collect()) == ["a.pdf", "c.pdf"]
    assert tables.files(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "reg.csv").write_text("idProcesso;numeroProcesso;classeJudicial;poloPassivo;assuntoPrincipal\n1; 22 ;c; Ana ;s\n2;33;c;;s\n")
    assert [tuple(r)[1:] for r in tables.registry_table(spark, str(tmp_path / "reg.csv")).collect()] == [("1", "22", "c", "Ana", "s")]
    one, two = tmp_path / "u1.csv", tmp_path / "u2.csv"
    one.write_text("a,b\n2,x\n")
    two.write_text("a\n1\n")
    assert [tuple(r) for r in tables.csv_union(spark, [str(one), str(two)], "a").collect()] == [("1", None, "u2.csv"), ("2", "x", "u1.csv")]
    control = tmp_path / "controle.json"
    control.write_text('{"processos": {"p": {"numero": "9", "tipo": "t"}}}')
    (tmp_path / "res").mkdir()
    (tmp_path / "res" / "r.json").write_text('{"numero": "8", "tipo": "f"}')
    given = lambda path: [tuple(r) for r in tables.control_or_files(spark, path, str(tmp_path / "res"), "numero string, tipo string", "*.json").collect()]
    assert given(str(control)) == [("9", "t")] and given(str(tmp_path / "none.json")) == [("8", "f")]
    ranked = spark.createDataFrame([("1", 5, "z"), ("2", 9, "y")], "numero string, score_prioridade int, outra string")
    sinks.write_ranked_csv(ranked, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True)
    assert back.columns == ["numero", "score_prioridade"] and back.count() == 2
    links = spark.createDataFrame([(1, "p", "a"), (2, "p", "b"), (3, "", "c")], "idx int, papel_processo string, v string")
    assert ['"b"' in r.json for r in sinks.link_json(links).collect()] == [True]
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    assert consolidate.file_count(files).first()[0] == 2 and consolidate.file_count(files.limit(0)).first()[0] == 0
    groups = spark.createDataFrame([(["1-2.3", "4-5.6"],)], "processos array<string>")
    stems = spark.createDataFrame([("1_2_3",)], "stem string")
    assert tuple(consolidate.coverage(groups, stems).first()) == (2, 1)
    text = spark.createDataFrame([("Vistos, etc.\nJULGO PROCEDENTE o pedido do autor\nfim",)], "t string")
    assert "PROCEDENTE" in text.select(T.decision_snippet(F.col("t"))).first()[0]
    assert text.select(classify.signal_hit(F.col("t"), "julgo"), classify.signal_hit(F.col("t"), r"^fim$", "m"), classify.signal_hit(F.col("t"), "nada")).first()[:] == (True, True, False)
    ratio = spark.createDataFrame([("x" * 100, "x" * 40), ("", "")], "a string, b string").select(quality.result_ratios(F.col("a"), F.col("b")).alias("r")).collect()
    assert [(r.r.tokens, round(r.r.reduction)) for r in ratio] == [(10, 60), (0, 0)]
    notice = spark.createDataFrame([("limit resets 3:30pm (America/Bahia)",), ("none",)], "t string").select(T.rate_limit(F.col("t")).alias("n"), T.wait_seconds(T.rate_limit(F.col("t")), F.lit("2024-01-01 15:00:00").cast("timestamp")).alias("w")).collect()
    assert (notice[0].n.hour, notice[0].n.minute, notice[0].w, notice[1].n) == (3, 30, 1800, None)
    log = spark.createDataFrame([("2024-01-01 10:00:00", "2024-01-01 11:30:00")], "inicio string, fim string").select(F.col("inicio").cast("timestamp").alias("inicio"), F.col("fim").cast("timestamp").alias("fim"))
    assert queues.sessions(log).first().minutos == 90
    found = spark.createDataFrame([("g", [("1", "why"), ("2", "so")])], "group_id string, processos_distintos array<struct<numero:string,justificativa:string>>")
    assert [tuple(r) for r in consolidate.distinct_rows(found).collect()] == [("g", "1", "why"), ("g", "2", "so")]
    commands = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "cmd int, item string")
    done = {r.cmd: r.complete for r in queues.loosely_complete(commands, commands.filter("cmd = 9"), commands.filter("item = 'b'").select("item"), "cmd", "item").collect()}
    assert done == {1: True, 2: False}


def test_best_names_equal_all_pairs():
    import random

    import numpy as np

    from docketmill.operators import linkage

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(2, 7)))
    names = [" ".join(sorted(word() for _ in range(rng.randint(1, 4)))) for _ in range(120)] + ["", "ana", "ana"]
    mine = [n[:-1] for n in names[:40]] + [" ".join(sorted(word() for _ in range(3))) for _ in range(20)] + ["", "ana"]
    pos = np.array(rng.sample(range(1000), len(names)))
    want = []
    for a in mine:
        best = max(((linkage.similarity(a, b), -p) for b, p in zip(names, pos.tolist())), default=None)
        want.append((best[0], -best[1]) if best[0] >= linkage.REVIEW else None)
    assert linkage.best_names(mine, names, pos) == want and None in want


def test_rendered_case_has_every_section(spark):
    from docketmill.plans.extraction import render_cases

    cover = "PJe - Processo Judicial Eletrônico\nNúmero do processo: 1\nClasse: Inquérito Policial\nValor da causa: R$ 10,00\nAssunto: Furto\nDocumentos\nTipo\n05/06/2020   Conclusos para despacho"
    sentence = "SENTENÇA\nVistos, etc. Julgo procedente o pedido e condeno o réu Fulano, CPF 123.456.789-01, em 10/02/2021.\nNum. 123456 - Pág. 2"
    remark = "certifico que transitou em julgado. termo de remessa ao arquivo, nada mais havendo nesta data"
    rows = [("0001", 1, cover), ("0001", 2, sentence), ("0001", 3, remark), ("0002", 1, None)]
    got = {r.numero: r.markdown for r in render_cases(spark.createDataFrame(rows, "numero string, pag int, text string")).collect()}
    one = got["0001"].split("\n")
    assert one[:2] == ["# 0001", ""] and one[2] == "**Classe:** Inquérito Policial  " and "**Valor da causa:** R$ 10,00  " in one
    assert "**Total de páginas:** 3  " in one and "| 05/06/2020 | Conclusos para despacho |" in one
    assert "- **CPFs**: 123.456.789-01" in one and any(x.startswith("- **Datas**: 10/02/2021") for x in one)
    assert any(x.startswith("## SENTENÇA (p.2") for x in one) or any("SENTEN" in x and x.startswith("## ") for x in one)
    assert one[-1] == "" and one[-2] != "" and "- **Linha do tempo**:" in one
    two = got["0002"]
    assert two == "# 0002\n\n**Total de páginas:** 1  \n**Peças identificadas:** 0\n\n---\n\n## SINALIZADORES PROCESSUAIS (extração automática)\n\n- **Fase aparente**: Sem eventos de cautelar identificados\n- **Provável status da cautelar**: SEM CAUTELAR DETECTADA\n"
