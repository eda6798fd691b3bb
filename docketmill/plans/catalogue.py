"""Queries over the driver's tables with the SQL that they are held against.

The tables hold no court texts, so texts come from templates that both engines evaluate alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import classify, fixed_values as V, quality, scoring, text as T
from ..operators import consolidate, dedup, linkage, pieces, queues
from .extraction import extract_cases
from .triage import rank_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def case_of(key: str, values: list[str]) -> str:
    """A CASE over key modulo the number of values."""
    n = len(values)
    return f"CASE {key} % {n} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1])) + f" ELSE {values[-1]} END"


def quoted(*texts: str) -> list[str]:
    return ["'" + t + "'" for t in texts]


# ---------------------------------------------------------------- scoring

CASES = [
    "o_orderkey AS k",
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'PRESCRITO' WHEN '2-HIGH' THEN 'IMINENTE' WHEN '3-MEDIUM' THEN 'ATENCAO' WHEN '4-NOT SPECIFIED' THEN 'BAIXO' ELSE 'SEM RISCO' END AS risco",
    "CAST((o_orderkey * 7) % 2200 AS INT) AS dias",
    "o_orderstatus = 'O' AS preso",
    case_of("o_orderkey", quoted("expedir citação", "minutar sentença", "intimar delegado", "assinar", "aguardar laudo", "solicitar laudo", "pronunciar", "homologar anpp", "aguardar contrarrazões", "despachar", "nada", "Designar Audiência")) + " AS ato",
    case_of("o_custkey", quoted("CRITICA", "ALTA", "MEDIA", "BAIXA", "OUTRA")) + " AS crime",
    case_of("o_custkey", quoted("Homicídio simples", "roubo qualificado", "furto", "Tráfico de drogas", "lesão", "Violência doméstica")) + " AS assunto",
    case_of("o_orderkey", quoted("Juri", "Termo Circunstanciado", "Inquérito Policial", "Ação Penal - Procedimento Sumário", "", "APSumss", "Execução", "Ação Penal - Procedimento Ordinário", "Tribunal do Júri")) + " AS classe",
    "CAST(o_custkey % 6 AS INT) AS facil",
]
CASES_SQL = f"(SELECT {', '.join(CASES)} FROM orders)"


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(*CASES)


def keyword_case(column: str, pairs: list[tuple[str, str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({column}), '{k}') THEN {v}" for k, v in pairs) + f" ELSE {other} END"


EXECUTOR_SQL = keyword_case("ato", [(k, f"'{who}'") for who, keys in V.EXECUTORS for k in keys], "'Verificar'")
EASE_SQL = keyword_case("ato", [(k, str(n)) for k, n in V.EASE], "3")
RISK_SQL = "CASE risco WHEN 'PRESCRITO' THEN 15000 WHEN 'IMINENTE' THEN 12000 WHEN 'ATENCAO' THEN 10000 WHEN 'BAIXO' THEN 500 ELSE 0 END"
STALL_SQL = "CASE WHEN dias >= 1825 THEN 5000 WHEN dias >= 1095 THEN 4000 WHEN dias >= 730 THEN 3000 WHEN dias >= 365 THEN 2000 WHEN dias >= 180 THEN 1000 ELSE 500 END"
IMPACT_SQL = f"({RISK_SQL} + {STALL_SQL} + CASE WHEN preso THEN 3000 ELSE 0 END + CASE crime WHEN 'CRITICA' THEN 800 WHEN 'ALTA' THEN 400 WHEN 'MEDIA' THEN 200 WHEN 'BAIXA' THEN 100 ELSE 200 END)"
GOAL_SQL = f"CASE WHEN {RISK_SQL} >= 10000 THEN 'Prescrição' WHEN dias >= 365 THEN 'Congestionamento' WHEN preso THEN 'Réu preso' ELSE 'Outras' END"
LEVEL_SQL = "CASE WHEN {0} >= 15000 THEN 'URGENTÍSSIMA' WHEN {0} >= 10000 THEN 'URGENTE' WHEN {0} >= 5000 THEN 'ALTA' WHEN {0} >= 2000 THEN 'MÉDIA' ELSE 'NORMAL' END"
SCORE_SQL = f"CAST(floor({IMPACT_SQL} * (4 + {EASE_SQL} - 1) / 4.0) AS INT)"


@query("priority_score", f"""SELECT k, {SCORE_SQL} AS score_prioridade, CAST({IMPACT_SQL} AS INT) AS score_impacto, CAST({EASE_SQL} AS INT) AS facilidade_ato,
{GOAL_SQL} AS meta_principal, {EXECUTOR_SQL} AS executor, {LEVEL_SQL.format(SCORE_SQL)} AS nivel FROM {CASES_SQL}""")
def priority_score(spark, sf_dir):
    p = scoring.priority(F.col("risco"), F.col("dias"), F.col("ato"), F.col("preso"), F.col("crime"))
    return cases(spark, sf_dir).withColumn("p", p).select("k", "p.*", scoring.level(F.col("p.score_prioridade")).alias("nivel"))


@query("urgency_score", f"""WITH s AS (SELECT k, dias + CASE WHEN contains(lower(assunto), 'homicídio') OR contains(lower(assunto), 'latrocínio') OR contains(lower(assunto), 'estupro') OR contains(lower(assunto), 'vulnerável') OR classe = 'Juri' THEN 2000
WHEN contains(lower(assunto), 'tráfico') OR contains(lower(assunto), 'roubo') OR contains(lower(assunto), 'armas') OR contains(lower(assunto), 'violência doméstica') OR contains(lower(assunto), 'mulher') OR contains(lower(assunto), 'medida protetiva') THEN 1000 ELSE 0 END
+ CASE WHEN dias > 730 THEN 500 WHEN dias > 365 THEN 300 ELSE 0 END AS score FROM {CASES_SQL})
SELECT k, CAST(score AS INT) AS score, CASE WHEN score >= 1500 THEN 'CRITICA' WHEN score >= 800 THEN 'ALTA' WHEN score >= 400 THEN 'MEDIA' ELSE 'BAIXA' END AS urgencia FROM s""")
def urgency_score(spark, sf_dir):
    return cases(spark, sf_dir).select("k", scoring.urgency(F.col("dias"), F.col("assunto"), F.col("classe")).alias("u")).select("k", "u.*")


@query("fallback_priority", f"SELECT k, CAST(floor({IMPACT_SQL} * (4 + facil - 1) / 4.0) AS INT) AS score, {GOAL_SQL} AS meta FROM {CASES_SQL}")
def fallback_priority(spark, sf_dir):
    f = scoring.fallback_priority(F.col("risco"), F.col("dias"), F.col("facil"), F.col("preso"), F.col("crime"))
    return cases(spark, sf_dir).select("k", f.alias("f")).select("k", "f.*")


TRIAGE_COLUMNS = {"pos": "k", "numero": "CAST(k AS STRING)", "risco_prescricao": "risco", "dias_parado": "CAST(dias AS STRING)", "proximo_ato": "ato", "reu_preso": "CASE WHEN preso THEN 'Sim' ELSE 'false' END", "urgencia_crime": "crime", "executor": "CASE WHEN k % 3 = 0 THEN 'Juiz' ELSE '' END", "facilidade_ato": "facil"}


def triage(spark, sf_dir) -> DataFrame:
    return cases(spark, sf_dir).selectExpr(*[f"{v} AS {k}" for k, v in TRIAGE_COLUMNS.items()])


@query("triage_rank", f"""WITH t AS (SELECT k AS pos, {SCORE_SQL} AS score_prioridade, {GOAL_SQL} AS meta_principal,
CASE WHEN k % 3 = 0 THEN 'Juiz' ELSE {EXECUTOR_SQL} END AS executor, CAST(CASE WHEN facil <> 0 THEN facil ELSE {EASE_SQL} END AS INT) AS facilidade_ato FROM {CASES_SQL})
SELECT pos, score_prioridade, meta_principal, executor, facilidade_ato, {LEVEL_SQL.format('score_prioridade')} AS nivel_prioridade, row_number() OVER (ORDER BY score_prioridade DESC, pos) AS place FROM t""")
def triage_rank(spark, sf_dir):
    return rank_records(triage(spark, sf_dir)).select("pos", "score_prioridade", "meta_principal", "executor", "facilidade_ato", "nivel_prioridade", "place")


@query("level_counts", f"SELECT {LEVEL_SQL.format(SCORE_SQL)} AS nivel_prioridade, count(*) AS n FROM {CASES_SQL} GROUP BY 1")
def level_counts(spark, sf_dir):
    return consolidate.level_counts(consolidate.enrich(triage(spark, sf_dir)))


@query("executor_counts", f"SELECT CASE WHEN k % 3 = 0 THEN 'Juiz' ELSE {EXECUTOR_SQL} END AS executor, count(*) AS n FROM {CASES_SQL} GROUP BY 1")
def executor_counts(spark, sf_dir):
    return consolidate.executor_counts(consolidate.enrich(triage(spark, sf_dir)))


@query("goal_counts", f"SELECT {GOAL_SQL} AS meta_principal, count(*) AS n FROM {CASES_SQL} GROUP BY 1")
def goal_counts(spark, sf_dir):
    return consolidate.goal_counts(consolidate.enrich(triage(spark, sf_dir)))


@query("risk_counts", f"SELECT count(*) FILTER (risco = 'PRESCRITO') AS prescritos, count(*) FILTER (risco = 'IMINENTE') AS iminentes, count(*) FILTER (risco = 'ATENCAO') AS atencao, count(*) FILTER (preso) AS presos FROM {CASES_SQL}")
def risk_counts(spark, sf_dir):
    return consolidate.risk_counts(consolidate.enrich(triage(spark, sf_dir)))


@query("display_names", f"SELECT k, CASE WHEN preso THEN 'SIM' ELSE 'NÃO' END AS reu_preso, CASE facil WHEN 5 THEN '5-Trivial' WHEN 4 THEN '4-Simples' WHEN 3 THEN '3-Médio' WHEN 2 THEN '2-Complexo' WHEN 1 THEN '1-Pesado' ELSE CAST(facil AS VARCHAR) END AS facilidade FROM {CASES_SQL}")
def display_names(spark, sf_dir):
    return cases(spark, sf_dir).select("k", scoring.custody_text(F.col("preso")).alias("reu_preso"), scoring.ease_text(F.col("facil")).alias("facilidade"))


@query("limitation_terms", "SELECT k, CASE WHEN m >= 12 THEN 20 WHEN m >= 8 THEN 16 WHEN m >= 4 THEN 12 WHEN m >= 2 THEN 8 WHEN m >= 1 THEN 4 ELSE 3 END AS anos FROM (SELECT l_orderkey * 10 + l_linenumber AS k, l_quantity / 3.0 AS m FROM lineitem)")
def limitation_terms(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS k", "l_quantity / 3.0D AS m")
    return rows.select("k", scoring.limitation_years(F.col("m")).alias("anos"))


@query("class_code", "SELECT k, CASE " + " ".join(f"WHEN contains(lower(trim(classe)), '{n.lower()}') OR contains('{n.lower()}', lower(trim(classe))) THEN '{code}'" for code, names in V.CASE_CLASSES for n in names) + f" ELSE trim(classe) END AS codigo FROM {CASES_SQL}")
def class_code(spark, sf_dir):
    return cases(spark, sf_dir).select("k", classify.class_code(F.col("classe")).alias("codigo"))


@query("class_filter", f"SELECT k FROM {CASES_SQL} WHERE " + " OR ".join(f"contains(lower(trim(classe)), '{n}') OR contains('{n}', lower(trim(classe)))" for n in ["inquérito policial", "ip", "termo circunstanciado", "tco"]))
def class_filter(spark, sf_dir):
    return cases(spark, sf_dir).filter(classify.accepted_class(F.col("classe"), classify.parse_filter("IP+tco"))).select("k")


def re2(pattern: str, flags: str) -> str:
    """A pattern for the checking engine, which has no lookahead: a line end is captured instead."""
    p = pattern.replace("(?=\\n|$)", "(\\n|\\z)").replace("(?=\\n\\n|\\Z)", "(\\n\\n|\\z)").replace("\\Z", "\\z")
    return ("(?" + flags + ")" if flags else "") + p


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def matches(column: str, pattern: str, flags: str) -> str:
    return f"regexp_matches({column}, {lit(re2(pattern, flags))})"


@query("class_route", "SELECT k, CASE " + " ".join(f"WHEN {matches('classe || chr(32) || assunto', p, f)} THEN '{k}'" for p, f, k in V.CLASS_ROUTES) + f" ELSE 'outros' END AS rota FROM {CASES_SQL}")
def class_route(spark, sf_dir):
    return cases(spark, sf_dir).select("k", classify.class_route(F.col("classe"), F.col("assunto")).alias("rota"))


# ---------------------------------------------------------------- relational operators

@query("first_wins", "SELECT text, min(doc_id) AS doc_id FROM documents WHERE trim(text) <> '' GROUP BY text")
def first_wins(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", "text").filter("trim(text) <> ''")
    return dedup.first_wins(rows, ["text"], ["doc_id"])


@query("last_wins", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_wins(spark, sf_dir):
    return dedup.last_wins(read(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), ["user_id"], ["event_id"])


@query("fixed_batches", """WITH o AS (SELECT o_orderkey, o_orderpriority AS prompt, CAST(o_totalprice AS BIGINT) AS score, o_orderkey % 4 = 0 AS tem_pdf FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY tem_pdf, prompt ORDER BY score DESC, o_orderkey) AS place FROM o),
c AS (SELECT *, (place - 1) // CASE WHEN tem_pdf THEN 3 ELSE 15 END AS chunk FROM r)
SELECT o_orderkey, place, CAST(dense_rank() OVER (ORDER BY NOT tem_pdf, prompt, chunk) AS INT) AS num FROM c""")
def fixed_batches(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderpriority AS prompt", "CAST(rint(o_totalprice) AS BIGINT) AS score", "o_orderkey % 4 = 0 AS tem_pdf")
    return queues.fixed_batches(rows, "prompt", [F.desc("score"), F.asc_nulls_last("o_orderkey")], "tem_pdf").select("o_orderkey", "place", "num")


@query("extraction_chunks", "SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 5 + 1 AS num FROM part")
def extraction_chunks(spark, sf_dir):
    return queues.chunks(read(spark, sf_dir, "part").select("p_partkey"), [F.asc("p_partkey")]).select("p_partkey", F.col("num").cast("long").alias("num"))


@query("seq_ids", "SELECT p_partkey, p_brand || '_' || CASE WHEN rn < 1000 THEN lpad(CAST(rn AS VARCHAR), 3, '0') ELSE CAST(rn AS VARCHAR) END AS group_id FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS rn FROM part)")
def seq_ids(spark, sf_dir):
    return queues.sequential_ids(read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), "p_brand", [F.asc("p_size"), F.asc("p_partkey")]).select("p_partkey", "group_id")


@query("adaptive_packing", """WITH RECURSIVE g AS (SELECT conv_id, conv_id % 7 AS lane, count(*) AS n FROM conversations GROUP BY conv_id),
o AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY conv_id) AS rn FROM g),
f AS (SELECT lane, conv_id, rn, 1 AS num, CASE WHEN n >= 6 THEN 0 ELSE n END AS held FROM o WHERE rn = 1
UNION ALL SELECT o.lane, o.conv_id, o.rn, CASE WHEN o.n < 6 AND f.held > 0 AND f.held + o.n <= 6 THEN f.num ELSE f.num + 1 END,
CASE WHEN o.n >= 6 THEN 0 WHEN f.held > 0 AND f.held + o.n <= 6 THEN f.held + o.n ELSE o.n END FROM f JOIN o ON o.lane = f.lane AND o.rn = f.rn + 1)
SELECT lane, conv_id, CAST(num AS INT) AS num FROM f""")
def adaptive_packing(spark, sf_dir):
    groups = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("lane", F.col("conv_id") % 7)
    return queues.adaptive_packing(groups, ["lane"], "conv_id", "n").select("lane", "conv_id", "num")


@query("size_buckets", "SELECT count(*) FILTER (n <= 3) AS pequenos, count(*) FILTER (n BETWEEN 4 AND 5) AS medios, count(*) FILTER (n >= 6) AS grandes FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)")
def size_buckets(spark, sf_dir):
    return consolidate.size_buckets(read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_processos")))


@query("fixed_category_counts", "SELECT c AS categoria, (SELECT count(*) FROM customer WHERE c_mktsegment = c) AS n FROM (VALUES ('AUTOMOBILE'), ('BUILDING'), ('NO SUCH'), ('MACHINERY')) t(c)")
def fixed_category_counts(spark, sf_dir):
    return consolidate.category_counts(read(spark, sf_dir, "customer"), "c_mktsegment", ["AUTOMOBILE", "BUILDING", "NO SUCH", "MACHINERY"])


@query("ordered_collect", "SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY f, l_returnflag) AS flags FROM (SELECT l_orderkey, l_returnflag, min(l_linenumber) AS f FROM lineitem GROUP BY ALL) GROUP BY 1")
def ordered_collect(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(dedup.collect_in_order(F.col("l_returnflag"), F.col("l_linenumber")).alias("v"))
    return rows.select("l_orderkey", F.array_join("v", ",").alias("flags"))


@query("pending_split", """SELECT o_orderkey AS numero, coalesce(md5(CAST(o_orderkey AS VARCHAR)) || '_v1' = CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE md5(CAST(o_orderkey AS VARCHAR)) || '_v1' END AND o_orderkey % 2 = 1
AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 3), false) AS hit FROM orders""")
def pending_split(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    key = T.cache_key(F.col("o_orderkey").cast("string").cast("binary"), "v1")
    files = orders.select(F.col("o_orderkey").alias("numero"), key.alias("cache_key"))
    cache = orders.filter("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("numero"), F.when(F.col("o_orderkey") % 3 == 0, "old").otherwise(key).alias("cache_key"))
    outputs = read(spark, sf_dir, "lineitem").filter("l_linenumber = 3").select(F.col("l_orderkey").alias("numero"))
    return queues.pending_split(files, cache, outputs).select("numero", "hit")


@query("cache_status", """SELECT status, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'invalid' WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 4) THEN 'valid' ELSE 'orphan' END AS status FROM orders) GROUP BY 1""")
def cache_status(spark, sf_dir):
    cache = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("numero"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.lit("abc_v1")).alias("cache_key"))
    outputs = read(spark, sf_dir, "lineitem").filter("l_linenumber = 4").select(F.col("l_orderkey").alias("numero"))
    return queues.cache_status(cache, outputs, "v1").groupBy("status").agg(F.count("*").alias("n"))


@query("completion_status", """SELECT l_orderkey AS cmd, count(*) AS n, count(*) FILTER (l_returnflag = 'N') AS done,
CASE WHEN bool_or(l_returnflag = 'A') THEN 'ERRO' WHEN count(*) FILTER (l_returnflag = 'N') = count(*) THEN 'OK' WHEN count(*) FILTER (l_returnflag = 'N') > 0 THEN 'PARCIAL' ELSE 'ERRO' END AS status FROM lineitem GROUP BY 1""")
def completion_status(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cmd"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate").alias("item"), "l_returnflag")
    results = rows.filter("l_returnflag <> 'R'").select("item", (F.col("l_returnflag") == "A").alias("broken"))
    return queues.completion(rows.select("cmd", "item"), results, "cmd", "item")


@query("undone_items", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 2)")
def undone_items(spark, sf_dir):
    done = read(spark, sf_dir, "lineitem").filter("l_linenumber = 2").select(F.col("l_orderkey").alias("o_orderkey"))
    return queues.undone(read(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey")


@query("undone_commands", "SELECT DISTINCT l_orderkey AS cmd FROM lineitem WHERE l_returnflag <> 'N'")
def undone_commands(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cmd"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate").alias("item"), "l_returnflag")
    return queues.undone_commands(rows.select("cmd", "item"), rows.filter("l_returnflag = 'N'").select("item"), "cmd", "item")


@query("range_limit", "SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 100 AND 5000 ORDER BY 1 LIMIT 50")
def range_limit(spark, sf_dir):
    """The first commands of a range: the limit is the operator's own."""
    return queues.in_range(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 100, 5000, 50)


@query("progress", "SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'F') / count(*) * 100 AS percent FROM orders")
def progress(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return queues.progress(orders, orders.filter("o_orderstatus = 'F'"), "o_orderkey")


@query("run_totals", "SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS tokens, CAST(sum(o_orderkey % 50) AS BIGINT) AS paginas FROM orders GROUP BY 1")
def run_totals(spark, sf_dir):
    return consolidate.run_totals(read(spark, sf_dir, "orders").selectExpr("o_orderstatus AS status", "o_custkey AS tokens", "o_orderkey % 50 AS paginas"))


@query("checkpoint_items", "SELECT user_id AS item, arg_max(event_type, (ts, event_id)) AS arquivo FROM events GROUP BY 1")
def checkpoint_items(spark, sf_dir):
    log = read(spark, sf_dir, "events").select(F.col("event_id").alias("cmd"), F.col("user_id").alias("item"), F.col("ts").alias("data"), F.col("event_type").alias("arquivo"))
    return queues.checkpoint_state(log)["processos_analisados"].select("item", "arquivo")


@query("checkpoint_commands", "SELECT DISTINCT event_id % 977 AS cmd, max(event_id % 977) OVER () AS ultimo FROM events")
def checkpoint_commands(spark, sf_dir):
    log = read(spark, sf_dir, "events").select((F.col("event_id") % 977).alias("cmd"), F.col("user_id").alias("item"), F.col("ts").alias("data"), F.col("event_type").alias("arquivo"))
    state = queues.checkpoint_state(log)
    return state["comandos_concluidos"].join(F.broadcast(state["ultimo_comando"])).select("cmd", F.col("ultimo_comando").alias("ultimo"))  # one row


@query("command_lists", """SELECT l_orderkey AS cmd, count(*) AS total, count(*) FILTER (d) AS done, bool_and(d) AS concluido, bool_or(d) AND NOT bool_and(d) AS parcial
FROM (SELECT l_orderkey, l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 25) AS d FROM lineitem) GROUP BY 1""")
def command_lists(spark, sf_dir):
    commands = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cmd"), F.col("l_partkey").alias("item"))
    return queues.command_lists(commands, read(spark, sf_dir, "part").filter("p_size < 25").select(F.col("p_partkey").alias("item")))


@query("sessions", "SELECT event_id AS k, CAST(floor((epoch(fim) - epoch(ts)) % 86400 / 60) AS INT) AS minutos FROM (SELECT event_id, ts, ts + INTERVAL 1 SECOND * CAST(event_id % 100000 AS BIGINT) AS fim FROM events)")
def sessions(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.col("event_id").alias("k"), F.col("ts").alias("inicio"), F.expr("ts + make_dt_interval(0, 0, 0, CAST(event_id % 100000 AS DECIMAL(18, 6)))").alias("fim"))
    return queues.sessions(rows).select("k", "minutos")


@query("loose_completion", """SELECT l_orderkey AS cmd, l_orderkey % 5 = 0 OR bool_or(l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7)) AS complete FROM lineitem GROUP BY 1""")
def loose_completion(spark, sf_dir):
    commands = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cmd"), F.col("l_partkey").alias("item"))
    return queues.loosely_complete(commands, commands.filter("cmd % 5 = 0"), read(spark, sf_dir, "part").filter("p_size = 7").select(F.col("p_partkey").alias("item")), "cmd", "item")


QUEUE = ["concat(lpad(CAST(k AS STRING), 7, '0'), '-01.2020.8.05.0001') AS numero", "classe", "assunto", "'t' AS tarefa", "dias", "'m' AS ultima_mov", "k AS pos"]
CODE_SQL = "CASE " + " ".join(f"WHEN contains(lower(trim(classe)), '{n.lower()}') OR contains('{n.lower()}', lower(trim(classe))) THEN '{code}'" for code, names in V.CASE_CLASSES for n in names) + " ELSE trim(classe) END"


@query("enriched_queue", f"""SELECT k AS pos, {CODE_SQL} AS classe, dias AS dias_parado, lpad(CAST(k AS VARCHAR), 7, '0') || '_01_2020_8_05_0001.md' AS txt_arquivo,
k IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 5) AS tem_pdf, k IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 6) AS ja FROM {CASES_SQL}""")
def enriched_queue(spark, sf_dir):
    """Cases with texts at hand and those done."""
    lines = read(spark, sf_dir, "lineitem")
    number = F.concat(F.lpad(F.col("l_orderkey").cast("string"), 7, "0"), F.lit("-01.2020.8.05.0001"))
    stems = lines.filter("l_linenumber = 5").select(T.file_of_case_number(number, "").alias("stem"))
    done = lines.filter("l_linenumber = 6").select(number.alias("numero"))
    return queues.enrich_cases(cases(spark, sf_dir).selectExpr(*QUEUE), stems, done).select("pos", "classe", "dias_parado", "txt_arquivo", "tem_pdf", "ja")


@query("coverage", "SELECT count(*) AS total, count(*) FILTER (l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 20)) AS com_texto FROM lineitem")
def coverage(spark, sf_dir):
    """Of all groups' cases how many have a text."""
    groups = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.concat(F.lit("1-2."), F.col("l_partkey").cast("string"))).alias("processos"))
    return consolidate.coverage(groups, read(spark, sf_dir, "part").filter("p_size > 20").select(F.concat(F.lit("1_2_"), F.col("p_partkey").cast("string")).alias("stem")))


@query("groups_done", "SELECT l_orderkey AS group_id, bool_or(l_linenumber = 4) OR l_orderkey % 9 = 0 AS done FROM lineitem GROUP BY 1")
def groups_done(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    groups = lines.select(F.col("l_orderkey").alias("group_id")).distinct()
    analyses = lines.select(F.col("l_orderkey").alias("group_id"), F.when(F.col("l_linenumber") == 4, "x").alias("campo"))
    return queues.groups_done(groups, analyses, groups.filter("group_id % 9 = 0"), ["campo"])


PAIR_GROUPS = "SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS p FROM lineitem GROUP BY 1"


@query("explode_pairs", f"SELECT l_orderkey AS group_id, CAST(p[1] AS VARCHAR) AS processo_a, coalesce(CAST(p[2] AS VARCHAR), '') AS processo_b, array_to_string(p[3:], ', ') AS outros FROM ({PAIR_GROUPS})")
def explode_pairs(spark, sf_dir):
    cells = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"].cast("string"))
    rows = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("group_id")).agg(cells.alias("c"))
    rows = rows.select("group_id", F.array(F.struct(F.col("c").alias("processos"), F.lit("t").alias("tipo"), F.lit("j").alias("justificativa"))).alias("pares_litispendencia"))
    return consolidate.pair_rows(rows).select("group_id", "processo_a", "processo_b", "outros")


@query("flatten_nested", "SELECT o_orderkey AS \"id\", o_orderstatus AS \"caso.status\", o_orderpriority AS \"caso.prazo.nome\", CAST(o_custkey AS VARCHAR) || '; ' || CAST(o_orderkey AS VARCHAR) AS \"caso.partes\" FROM orders")
def flatten_nested(spark, sf_dir):
    deep = F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_orderpriority").alias("nome")).alias("prazo"), F.array("o_custkey", "o_orderkey").alias("partes"))
    return consolidate.flatten(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), deep.alias("caso")))


@query("json_first_wins", "SELECT user_id AS numero, arg_min(event_type, event_id) AS tipo FROM events GROUP BY 1")
def json_first_wins(spark, sf_dir):
    """JSON objects, parsed by a schema, of which the first of each key stays."""
    from ..sources.tables import first_records

    raw = read(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.col("user_id").cast("string").alias("numero"), F.col("event_type").alias("tipo"))).alias("j"))
    rows = raw.select(F.from_json("j", "numero string, tipo string").alias("r"), "event_id").select("r.*", F.lit("f").alias("file"), F.col("event_id").alias("pos"))
    return first_records(rows, "numero").select(F.col("numero").cast("long").alias("numero"), "tipo")


@query("ranked_groups", "SELECT o_orderkey AS pos, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 4 END, o_custkey DESC, o_orderkey) AS place FROM orders")
def ranked_groups(spark, sf_dir):
    p = F.when(F.col("o_orderpriority") == "1-URGENT", "URGENTE").when(F.col("o_orderpriority") == "2-HIGH", "ALTA").when(F.col("o_orderpriority") == "3-MEDIUM", "MEDIA").otherwise("?")
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), p.alias("prioridade"), F.col("o_custkey").alias("n_processos"))
    return consolidate.ranked_groups(rows).select("pos", "place")


# ---------------------------------------------------------------- ordered folds

@query("page_ranges", """WITH d AS (SELECT DISTINCT user_id, event_type AS num, CAST(event_id % 40 AS INT) AS pag FROM events),
f AS (SELECT user_id, event_type AS num, min(event_id) AS seen FROM events GROUP BY ALL),
i AS (SELECT *, pag - row_number() OVER (PARTITION BY user_id, num ORDER BY pag) AS island FROM d),
r AS (SELECT user_id, num, min(pag) AS a, max(pag) AS b FROM i GROUP BY user_id, num, island),
t AS (SELECT user_id, num, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ',' ORDER BY a) AS pp FROM r GROUP BY ALL)
SELECT t.user_id, string_agg('Num. ' || t.num || ' (p.' || pp || ')', ', ' ORDER BY seen) AS faixas FROM t JOIN f USING (user_id, num) GROUP BY 1""")
def page_ranges(spark, sf_dir):
    ids = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: F.struct(x["event_type"].alias("num"), (x["event_id"] % 40).cast("string").alias("pag")))
    return read(spark, sf_dir, "events").groupBy("user_id").agg(ids.alias("ids")).select("user_id", pieces.page_ranges(F.col("ids")).alias("faixas"))


@query("turn_fold", """WITH c AS (SELECT conv_id, turn, role, CASE WHEN lag(role) OVER w = role AND turn - lag(turn) OVER w <= 1 THEN 0 ELSE 1 END AS fresh FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id ORDER BY turn) AS ordem FROM c)
SELECT conv_id AS numero, CAST(ordem - 1 AS INT) AS ordem, role AS tipo, CAST(min(turn) AS INT) AS pag_ini, CAST(max(turn) AS INT) AS pag_fim FROM g GROUP BY conv_id, ordem, role""")
def turn_fold(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role").distinct()
    none = F.lit(None).cast("struct<num:string,pag:string>")
    rows = rows.select(F.col("conv_id").alias("numero"), F.col("turn").cast("int").alias("pag"), F.col("role").alias("tipo"), F.lit("x").alias("texto"), none.alias("doc_id"), F.lit(0.5).alias("confianca"))
    return pieces.fold_pages(rows).select("numero", "ordem", "tipo", "pag_ini", "pag_fim")


LADDER = [t for t, _ in V.EVENT_FLAGS]
EVENT_CASE = case_of("event_id", quoted(*LADDER, *["DOC"] * 40))


def _when(rungs, other: str) -> str:
    names = {flag: t for t, flag in V.EVENT_FLAGS}
    return "CASE " + " ".join("WHEN bool_or(tipo IN (" + ", ".join(f"'{names[c]}'" for c in cols) + f")) THEN '{label}'" for cols, label in rungs) + f" ELSE '{other}' END"


@query("event_ladder", f"SELECT user_id AS numero, {_when(pieces.PHASES, pieces.NO_PHASE)} AS fase_aparente, {_when(pieces.STATUSES, pieces.NO_STATUS)} AS provavel_status_cautelar, count(*) FILTER (tipo <> 'DOC') AS eventos FROM (SELECT user_id, {EVENT_CASE} AS tipo FROM events) GROUP BY 1")
def event_ladder(spark, sf_dir):
    rows = read(spark, sf_dir, "events").selectExpr("user_id AS numero", "event_id AS ordem", f"{EVENT_CASE} AS tipo", "CAST(1 AS INT) AS pag_ini", "CAST(1 AS INT) AS pag_fim", "'texto' AS texto", "cast(array() as array<struct<num:string,pag:string>>) AS doc_ids")
    return pieces.case_flags(pieces.case_events(rows)).select("numero", "fase_aparente", "provavel_status_cautelar", F.size("eventos").cast("long").alias("eventos"))


# ---------------------------------------------------------------- texts

LEGAL = quoted(
    "O Ministério Público oferece a presente denúncia contra o acusado",
    "SENTENÇA. Julgo procedente o pedido e condeno o réu",
    "cumprido o período de prova, art. 89, § 5, declaro extinta a punibilidade",
    "declaro extinta a punibilidade, art. 107 do cp",
    "ata de audiência. Aberta a audiência de custódia, auto de prisão em flagrante",
    "concedo a liberdade provisória com comparecimento mensal em juízo",
    "decreto a prisão preventiva do acusado em 10/02/2023",
    "boletim de ocorrência. Relato/histórico dos fatos",
    "vistos, etc. cite-se. intime-se. cumpra-se",
    "certifico que transitou em julgado. termo de remessa",
    "nada consta nesta folha senão texto corrido sem sinal algum",
    "alegações finais e memoriais finais da defesa",
    "mandado de citação. alvará de soltura",
)
EXTRA = quoted("Num. 123456 - Pág. 3", "Id 7654321", "ver https://pje.example/doc", "Pg. 3/10", "RG: 12.345.678 SSP", "", "Impresso por: alguém")
TEXTS = [
    "o_orderkey AS k",
    "concat(" + case_of("o_orderkey", LEGAL) + ", chr(10), " + case_of("o_custkey", LEGAL) + ", chr(10), " + case_of("o_orderkey", EXTRA) + ", chr(10), 'CPF ', lpad(CAST(o_custkey AS STRING), 11, '0'), ' fone (71) 9', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'), '-1234 em ', CAST(1 + o_orderkey % 28 AS STRING), '/0', CAST(1 + o_custkey % 9 AS STRING), '/2021', chr(10), '05/06/2020   ', " + case_of("o_custkey", quoted("Conclusos para despacho", "Juntada de documento novo", "curto")) + ") AS t",
]
TEXTS_SQL = f"(SELECT {', '.join(TEXTS)} FROM orders)"


def texts(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(*TEXTS)


def classify_sql(source: str, key: str, text: str) -> str:
    """The windowed classifier: windows, scores of each, sums over them, ranks, confidence."""

    def weight(p: str, f: str, w: int) -> str:
        return f"CASE WHEN {matches('w', p, f)} THEN CASE WHEN bonus AND {matches('left(w, 400)', p, f)} THEN {2 * w} ELSE {w} END ELSE 0 END"

    totals = ", ".join("(" + " + ".join(weight(p, f, w) for p, f, w in signals) + ")" for _, _, signals in V.PIECE_RULES)
    return f"""WITH d AS (SELECT {key} AS id, coalesce({text}, '') AS t, length(coalesce({text}, '')) > 3000 AS wide FROM {source}),
p AS (SELECT id, wide, CAST(i AS INT) AS i, substr(t, CAST(i * 1500 + 1 AS BIGINT), 3000) AS w, i = 0 AS bonus FROM (SELECT *, unnest(CASE WHEN wide THEN range(0, CAST(ceil((length(t) - 3000) / 1500) AS BIGINT) + 1) ELSE [0] END) AS i FROM d)
UNION ALL SELECT id, wide, -1, substr(t, 1, 6000), true FROM d WHERE wide),
v AS (SELECT id, wide, i, [{totals}] AS v FROM p),
e AS (SELECT id, wide, i, unnest(v) AS s, unnest(range(1, len(v) + 1)) AS r, unnest([{', '.join(str(least) for _, least, _ in V.PIECE_RULES)}]) AS least FROM v),
k AS (SELECT id, r, sum(s * CASE WHEN wide AND i = 0 THEN 1.5 ELSE 1.0 END) AS s, min(i) AS f, false AS spare FROM e WHERE i >= 0 AND s >= least GROUP BY id, r
UNION ALL SELECT id, r, s, 0, true FROM e WHERE i = -1 AND s >= least),
o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, f, r) AS n FROM k WHERE NOT spare OR id NOT IN (SELECT id FROM k WHERE NOT spare)),
b AS (SELECT id, max(CASE WHEN n = 1 THEN r END) AS r, CAST(round_even(max(CASE WHEN n = 1 THEN s END), 0) AS INT) AS score, CAST(coalesce(round_even(max(CASE WHEN n = 2 THEN s END), 0), 0) AS INT) AS second FROM o GROUP BY id)
SELECT d.id AS {key}, CASE WHEN b.id IS NULL THEN 'DOC' ELSE [{', '.join("'" + n + "'" for n, _, _ in V.PIECE_RULES)}][b.r] END AS tipo, coalesce(score, 0) AS score,
CASE WHEN b.id IS NULL OR score <= 0 THEN 0.0 ELSE round(0.65 * least(score / 30.0, 1.0) + 0.35 * CASE WHEN second <= 0 THEN 1.0 ELSE greatest(0.0, least((score - second) / greatest(score, 1), 1.0)) END, 3) END::DOUBLE AS confianca FROM d LEFT JOIN b ON d.id = b.id"""


@query("weighted_classify", classify_sql(TEXTS_SQL, "k", "t"))
def weighted_classify(spark, sf_dir):
    return texts(spark, sf_dir).select("k", classify.classify(F.col("t")).alias("c")).select("k", "c.*")


@query("document_types", classify_sql("documents", "doc_id", "text"))
def document_types(spark, sf_dir):
    """Every whole document of the table through the windowed classifier."""
    rows = read(spark, sf_dir, "documents").select("doc_id", classify.classify(F.col("text")).alias("c"))
    return rows.select("doc_id", "c.*")


LONG_SQL = f"(SELECT o_custkey AS k, string_agg(t, repeat(' texto corrido', 40) ORDER BY o.o_orderkey) AS t FROM {TEXTS_SQL} x JOIN orders o ON x.k = o.o_orderkey GROUP BY o_custkey)"


@query("windowed_classify", classify_sql(LONG_SQL, "k", "t"))
def windowed_classify(spark, sf_dir):
    """The texts of a customer as one long document: several windows, of which several score."""
    rows = texts(spark, sf_dir).join(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("k") == F.col("o_orderkey"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "t"))), lambda x: x["t"]), " texto corrido" * 40)
    return rows.groupBy(F.col("o_custkey").alias("k")).agg(whole.alias("t")).select("k", classify.classify(F.col("t")).alias("c")).select("k", "c.*")


@query("text_windows", "SELECT doc_id, CASE WHEN length(text) <= 3000 THEN 1 ELSE CAST(ceil((length(text) - 3000) / 1500) AS INT) + 1 END AS n, length(text) AS tokens FROM documents")
def text_windows(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(classify.windows(F.col("text"))).alias("n"), F.length("text").cast("long").alias("tokens"))


def _cleaned_sql(column: str) -> str:
    out = column
    for _, p, f in V.CLEANING_RULES:
        keep = "'\\1'" if "(?=" in p else "''"
        q = p if "(?=" in p else p
        out = f"regexp_replace({out}, {lit(re2(q, f))}, {keep}, 'g')"
    for p, put in ((r"\n{3,}", r"E'\n\n'"), (r"[ \t]+\n", r"E'\n'"), (r"\n\|[\s|]*\|\n", r"E'\n'")):
        out = f"regexp_replace({out}, {lit(p)}, {put}, 'g')"
    return f"trim({out}, E' \\n\\t\\r')"


@query("clean_text", f"SELECT k, {_cleaned_sql('t')} AS limpo FROM {TEXTS_SQL}")
def clean_text(spark, sf_dir):
    return texts(spark, sf_dir).select("k", T.clean_text(F.col("t")).alias("limpo"))


def _removal_sql() -> str:
    """A chain of common table expressions, one a rule: what it finds, then what it leaves."""
    steps, names = [f"r0 AS (SELECT k, t, [] AS o FROM {TEXTS_SQL})"], []
    for i, (name, p, f) in enumerate(V.CLEANING_RULES):
        ahead = "(?=" in p
        found = f"list_transform(regexp_extract_all(t, {lit(re2(p, f))}), lambda m: '{name}:' || left(" + ("rtrim(m, chr(10))" if ahead else "m") + ", 120))"
        put = "'\\1'" if ahead else "''"
        steps.append(f"r{i + 1} AS (SELECT k, regexp_replace(t, {lit(re2(p, f))}, {put}, 'g') AS t, o || {found} AS o FROM r{i})")
        names.append(name)
    return "WITH " + ",\n".join(steps) + f" SELECT k, CAST(len(o) AS INT) AS n, array_to_string(o, '|') AS achados FROM r{len(names)}"


@query("removal_log", _removal_sql())
def removal_log(spark, sf_dir):
    """All rules, with the text that each deletes."""
    log = texts(spark, sf_dir).select("k", T.removal_log(F.col("t")).alias("log"))
    return log.select("k", F.size("log").alias("n"), F.array_join(F.transform("log", lambda x: F.concat_ws(":", x["rule"], x["snippet"])), "|").alias("achados"))


def _last(arr: str) -> str:
    return f"{arr}[-1]"


_PAIRED, _ALONE = lit("(?i)" + V.DOC_ID_WITH_PAGE), lit("(?i)" + V.DOC_ID_ALONE)


@query("doc_id_last", f"""SELECT k, CASE WHEN {matches('t', V.DOC_ID_WITH_PAGE, 'i')} THEN regexp_extract_all(t, {_PAIRED}, 1)[-1] ELSE nullif(coalesce(regexp_extract_all(t, {_ALONE}, 1)[-1], ''), '') END AS num,
CASE WHEN {matches('t', V.DOC_ID_WITH_PAGE, 'i')} THEN regexp_extract_all(t, {_PAIRED}, 2)[-1] WHEN {matches('t', V.DOC_ID_ALONE, 'i')} THEN '1' END AS pag FROM {TEXTS_SQL}""")
def doc_id_last(spark, sf_dir):
    return texts(spark, sf_dir).select("k", T.doc_id(F.col("t")).alias("d")).select("k", "d.num", "d.pag")


def _first_seen(values: str, most: int) -> str:
    return f"array_to_string(list_filter({values}, lambda x, i: list_position({values}, x) = i)[1:{most}], ',')"


def _all(pattern: tuple[str, str], group: int) -> str:
    return f"regexp_extract_all(t, {lit(re2(*pattern))}, {group})"


_PHONES = f"list_transform(list_filter(list_zip({_all(V.PHONE, 1)}, {_all(V.PHONE, 2)}, {_all(V.PHONE, 3)}), lambda x: x[1] NOT IN ('19', '20')), lambda x: '(' || x[1] || ') ' || replace(x[2], ' ', '') || '-' || x[3])"
_DATES = f"list_transform(list_zip({_all(V.DATE, 1)}, {_all(V.DATE, 2)}, {_all(V.DATE, 3)}), lambda x: x[1] || '/' || x[2] || '/' || x[3])"


@query("pii_extract", f"""SELECT k, {_first_seen('c', 10)} AS cpfs, {_first_seen('r', 5)} AS rgs, {_first_seen('p', 5)} AS telefones, {_first_seen('z', 5)} AS ceps, {_first_seen('d', 15)} AS datas
FROM (SELECT k, {_all(V.CPF, 1)} AS c, {_all(V.RG, 1)} AS r, {_PHONES} AS p, {_all(V.CEP, 1)} AS z, {_DATES} AS d FROM {TEXTS_SQL})""")
def pii_extract(spark, sf_dir):
    d = texts(spark, sf_dir).select("k", T.personal_data(F.col("t")).alias("d"))
    return d.select("k", *[F.array_join(f"d.{c}", ",").alias(c) for c in ("cpfs", "rgs", "telefones", "ceps", "datas")])


_MOVED = lit("(\\d{2}/\\d{2}/\\d{4})\\s{1,10}([^\\n]{10,120})")


@query("movements", f"SELECT k, coalesce(array_to_string(list_transform(list_zip(regexp_extract_all(t, {_MOVED}, 1), regexp_extract_all(t, {_MOVED}, 2)), lambda x: x[1] || ' ' || trim(x[2])), '|'), '') AS mov FROM {TEXTS_SQL}")
def movements(spark, sf_dir):
    m = T.movements(F.col("t"))
    return texts(spark, sf_dir).select("k", F.array_join(F.transform(m, lambda x: F.concat_ws(" ", x["data"], x["descricao"])), "|").alias("mov"))


def _snippet_sql(name: str, p: str, f: str) -> str:
    found = f"regexp_extract(t, {lit(re2(p, f))})"
    at = f"strpos(t, {found})"
    return f"CASE WHEN {matches('t', p, f)} THEN '{name}:' || trim(substr(t, greatest(1, {at} - 80), {at} + length({found}) + 80 - greatest(1, {at} - 80)), E' \\n\\t\\r') END"


@query("measure_flags", "SELECT k, " + ", ".join(f"{matches('t', p, f)} AS {n}" for n, p, f in V.MEASURES) + ", NOT (" + " OR ".join(matches("t", p, f) for _, p, f in V.MEASURES) + f") AND {matches('t', 'art(?:igo|[.]|º)?[[:space:]]*319', 'i')} AS outras, array_to_string(list_filter([" + ", ".join(_snippet_sql(*m) for m in V.MEASURES) + f"], lambda x: x IS NOT NULL), '|') AS trechos FROM {TEXTS_SQL}")
def measure_flags(spark, sf_dir):
    m = texts(spark, sf_dir).select("k", classify.measures(F.col("t")).alias("m"))
    told = F.array_join(F.transform("m.trechos", lambda x: F.concat_ws(":", x["cautelar"], x["trecho"])), "|")
    return m.select("k", *[f"m.{n}" for n, _, _ in V.MEASURES], "m.outras", told.alias("trechos"))


COVER = [
    "c_custkey AS k",
    "concat(" + case_of("c_custkey", quoted("PJe - Processo Judicial", "folha")) + ", chr(10), " + case_of("c_custkey", quoted("Órgão julgador: 1ª Vara", "Orgao  julgador:  Vara  Unica", "")) + ", chr(10), " + case_of("c_custkey", quoted("MARIA DA SILVA (AUTOR)", "", "JOSE & CIA. (EXEQUENTE)", "Ana", "X (RÉU)")) + ", chr(10), " + case_of("c_custkey", quoted("BANCO S.A. (EXECUTADO)", "PEDRO DE JESUS (REU)", "")) + ", chr(10), " + case_of("c_custkey", quoted("Última distribuição : 01/02/2020", "Ultima distribuicao: ontem", "", "x")) + ", chr(10), " + case_of("c_custkey", quoted("Classe: Inquerito", "sem", "x")) + ", chr(10), " + case_of("c_custkey", quoted("Valor da causa: R$ 10,00", "", "y", "z")) + ", chr(10), " + case_of("c_custkey", quoted("Assunto: Furto", "", "Documentos juntados e Tipo", "", "Número do processo: 1")) + ") AS t",
]
COVER_SQL = f"(SELECT {', '.join(COVER)} FROM customer)"


@query("cover_score", "SELECT k, CAST(s AS INT) AS score, s >= 5 AS is_cover, s >= 3 AND s < 5 AS grey FROM (SELECT k, " + " + ".join(f"CASE WHEN {matches('t', p, f)} THEN {w} ELSE 0 END" for p, f, w in V.COVER_SIGNALS) + f" AS s FROM {COVER_SQL})")
def cover_score(spark, sf_dir):
    return read(spark, sf_dir, "customer").selectExpr(*COVER).select("k", classify.cover(F.col("t")).alias("c")).select("k", "c.*")


def _field(pattern: str, flags: str = "i") -> str:
    return f"trim(regexp_replace(regexp_extract(t, {lit(re2(pattern, flags))}, 1), '\\s+', ' ', 'g'))"


_PARTY = "([A-ZÁ-Ú][A-ZÁ-Ú\\s.\\-&]{2,80}?)\\s*\\((?:"


@query("cover_metadata", "SELECT k, " + ", ".join(f"{v} AS {c}" for c, v in {
    "classe": _field("Classe:\\s*\\*?\\*?([^\\n*]+)"), "assunto": _field("Assuntos?:\\s*\\*?\\*?([^\\n*]+)"), "orgao": _field("[ÓO]rg[ãa]o\\s+julgador:\\s*([^\\n*]+)"),
    "valor": _field("Valor\\s+da\\s+causa:\\s*R?\\$?\\s*([^\\n*]+)"), "distribuicao": _field("(?:Última|Ultima)\\s+distribui[çc][ãa]o\\s*:\\s*([^\\n*]+)"),
    "exequente": _field(_PARTY + "EXEQUENTE|REQUERENTE|AUTOR|RECLAMANTE|IMPETRANTE)\\)", ""), "executado": _field(_PARTY + "EXECUTADO|REQUERIDO|R[ÉE]U|RECLAMADO|IMPETRADO)\\)", ""),
}.items()) + " FROM " + COVER_SQL)
def cover_metadata(spark, sf_dir):
    return read(spark, sf_dir, "customer").selectExpr(*COVER).select("k", T.cover_metadata(F.col("t")).alias("c")).select("k", "c.*")


_WORDS = "regexp_split_to_array(trim(text, E' \\n\\t\\r'), '\\s+')"


@query("text_quality", f"""SELECT doc_id, length(text) - length(regexp_replace(text, {lit(V.CORRUPT_CHARS)}, '', 'g')) AS corrupt, length(text) - length(regexp_replace(text, {lit(V.VALID_CHARS)}, '', 'g')) AS valid,
CAST(len(list_filter({_WORDS}, lambda w: regexp_full_match(w, {lit(quality.REAL_WORD[1:-1])}))) AS BIGINT) AS words FROM documents""")
def text_quality(spark, sf_dir):
    n = F.length("text")
    rows = read(spark, sf_dir, "documents")
    t = F.col("text")
    return rows.select("doc_id", F.round(quality.corrupt_density(t) * n).cast("long").alias("corrupt"), F.round(quality.valid_ratio(t) * n).cast("long").alias("valid"), quality.real_words(t).cast("long").alias("words"))


@query("poor_text", f"""SELECT doc_id, CASE WHEN length(s) < 80 THEN 'short' WHEN (length(s) - length(regexp_replace(s, {lit(V.CORRUPT_CHARS)}, '', 'g'))) / length(s) > 0.02 THEN 'corrupt'
WHEN (length(s) - length(regexp_replace(s, {lit(V.VALID_CHARS)}, '', 'g'))) / length(s) < 0.55 THEN 'invalid'
WHEN len(list_filter(regexp_split_to_array(s, '\\s+'), lambda w: regexp_full_match(w, {lit(quality.REAL_WORD[1:-1])}))) < 15 THEN 'few words' ELSE '' END AS reason FROM (SELECT doc_id, trim(text, E' \\n\\t\\r') AS s FROM documents)""")
def poor_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", quality.poor_text(F.col("text")).alias("p")).select("doc_id", "p.reason")


@query("snippet_first_line", "SELECT doc_id, left(coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(trim(trim(x, ' \t'), '#'), ' ')), lambda x: length(x) > 10)[1], text), 120) AS linha FROM (SELECT doc_id, replace(text, '*', 'x') AS text FROM documents)")
def snippet_first_line(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.first_line(F.replace("text", F.lit("*"), F.lit("x"))).alias("linha"))


_LINES = "list_transform(string_split(t, chr(10)), lambda x: trim(trim(trim(trim(x, E' \\t\\r'), '#'), '*'), E' \\t\\r'))"


@query("decision_snippets", f"""SELECT k, coalesce(left(list_filter(l, lambda x: length(x) >= 15 AND regexp_matches(x, {lit(re2(*V.DECISION_VERBS))}))[1], 200), left(list_filter(l, lambda x: length(x) >= 20 AND NOT regexp_matches(x, {lit(re2(V.PREAMBLE[0], 'i'))}))[1], 200), trim(left(t, 200), E' \\n\\t\\r')) AS trecho
FROM (SELECT k, t, {_LINES} AS l FROM {TEXTS_SQL})""")
def decision_snippets(spark, sf_dir):
    return texts(spark, sf_dir).select("k", T.decision_snippet(F.col("t")).alias("trecho"))


_OCR = f"""SELECT doc_id, CASE WHEN length(s) = 0 THEN 0.0 ELSE (length(s) - length(regexp_replace(s, {lit(V.VALID_CHARS)}, '', 'g'))) / length(s) - 5 * ((length(s) - length(regexp_replace(s, {lit(V.CORRUPT_CHARS)}, '', 'g'))) / length(s))
+ least(len(list_filter(regexp_split_to_array(s, '\\s+'), lambda w: length(w) >= 3)) / 200.0, 1.0) END AS q, length(s) AS n FROM (SELECT doc_id, trim(coalesce(text, ''), E' \\n\\t\\r') AS s FROM documents)"""


@query("ocr_quality", f"SELECT doc_id, CAST(round(q * 1000) AS BIGINT) AS q, n > 0 AND (q + least(n / 1000.0, 5.0) >= 1.5) AS bom FROM ({_OCR})")
def ocr_quality(spark, sf_dir):
    """The quality of whole texts in thousandths, and whether they win over a fixed worth of 1.5."""
    t = F.col("text")
    n = F.length(T.strip(T.filled(t)))
    q = read(spark, sf_dir, "documents").select("doc_id", quality.ocr_quality(t).alias("q"), n.alias("n"))
    return q.select("doc_id", F.round(F.col("q") * 1000).cast("long").alias("q"), ((F.col("n") > 0) & (F.col("q") + F.least(F.col("n") / 1000.0, F.lit(5.0)) >= 1.5)).alias("bom"))


@query("result_ratios", "SELECT k, CAST(length(t) // 8 AS INT) AS tokens, CAST(round((1 - (length(t) // 2) / length(t)) * 10000) AS BIGINT) AS reducao FROM " + TEXTS_SQL)
def result_ratios(spark, sf_dir):
    half = F.substring(F.col("t"), F.lit(1), F.floor(F.length("t") / 2).cast("int"))
    r = texts(spark, sf_dir).select("k", quality.result_ratios(F.col("t"), half).alias("r"))
    return r.select("k", "r.tokens", F.round(F.col("r.reduction") * 100).cast("long").alias("reducao"))


SCALARS = ["c_custkey AS k", "concat(' ', c_name, '  DA  SILVA de ', c_mktsegment, ' (reu) ') AS nome", "lpad(CAST(c_custkey AS STRING), CASE WHEN c_custkey % 4 = 0 THEN 9 ELSE 11 END, '0') AS cpf",
           "concat('55', lpad(CAST(c_custkey AS STRING), CASE WHEN c_custkey % 2 = 0 THEN 10 ELSE 11 END, '7')) AS fone", "concat(CAST(1 + c_custkey % 28 AS STRING), '-', CAST(1 + c_custkey % 12 AS STRING), '.', lpad(CAST(c_custkey % 100 AS STRING), 2, '0')) AS data"]
SCALARS_SQL = f"(SELECT {', '.join(SCALARS)} FROM customer)"


@query("format_scalars", f"""SELECT k, CASE WHEN length(cpf) = 11 THEN left(cpf, 3) || '.' || substr(cpf, 4, 3) || '.' || substr(cpf, 7, 3) || '-' || substr(cpf, 10) ELSE cpf END AS cpf,
CASE WHEN length(fone) = 13 THEN '(' || substr(fone, 3, 2) || ') ' || substr(fone, 5, 5) || '-' || substr(fone, 10) ELSE '(' || substr(fone, 3, 2) || ') ' || substr(fone, 5, 4) || '-' || substr(fone, 9) END AS fone,
lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0') || '/' || lpad(CAST(1 + k % 12 AS VARCHAR), 2, '0') || '/' || CASE WHEN k % 100 <= 30 THEN '20' ELSE '19' END || lpad(CAST(k % 100 AS VARCHAR), 2, '0') AS data FROM {SCALARS_SQL}""")
def format_scalars(spark, sf_dir):
    return read(spark, sf_dir, "customer").selectExpr(*SCALARS).select("k", T.format_cpf(F.col("cpf")).alias("cpf"), T.format_phone(F.col("fone")).alias("fone"), T.format_date(F.col("data")).alias("data"))


@query("title_case", "SELECT c_custkey AS k, upper(left(c_name, 1)) || lower(substr(c_name, 2)) || ' da Silva de ' || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' (reu)' AS nome FROM customer")
def title_case(spark, sf_dir):
    return read(spark, sf_dir, "customer").selectExpr(*SCALARS).select("k", T.title_name(F.col("nome")).alias("nome"))


@query("match_names", "SELECT c_custkey AS k, array_to_string(list_sort([lower(c_name), 'da', 'silva', 'de', lower(c_mktsegment)]), ' ') AS nome FROM customer")
def match_names(spark, sf_dir):
    return read(spark, sf_dir, "customer").selectExpr(*SCALARS).select("k", T.match_name(F.col("nome")).alias("nome"))


@query("case_number", "SELECT o_orderkey AS k, n AS numero, replace(replace(n, '.', '_'), '-', '_') || '.md' AS arquivo FROM (SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || '-01.2020.8.05.' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS n FROM orders)")
def case_number(spark, sf_dir):
    n = F.expr("concat(lpad(CAST(o_orderkey AS STRING), 7, '0'), '-01.2020.8.05.', lpad(CAST(o_custkey % 10000 AS STRING), 4, '0'))")
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), T.file_of_case_number(n).alias("arquivo"))
    return rows.select("k", T.case_number_of_file(F.concat(F.lit("/x/"), "arquivo")).alias("numero"), "arquivo")


@query("label_normalize", "SELECT k, CASE l WHEN 'BO' THEN 'BOLETIM_OCORRENCIA' WHEN 'apf' THEN 'AUTO_PRISAO_FLAGRANTE' WHEN 'Sentença' THEN 'SENTENCA' WHEN 'despacho ' THEN 'DESPACHO' WHEN 'anpp' THEN 'ANPP' WHEN 'alegacoes_finais' THEN 'ALEGACOES_FINAIS' ELSE 'DOC' END AS rotulo FROM (SELECT p_partkey AS k, " + case_of("p_partkey", quoted("BO", "apf", "Sentença", "despacho ", "anpp", "alegacoes_finais", "", "outra coisa")) + " AS l FROM part)")
def label_normalize(spark, sf_dir):
    l = F.expr(case_of("p_partkey", quoted("BO", "apf", "Sentença", "despacho ", "anpp", "alegacoes_finais", "", "outra coisa")))  # noqa: E741
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), classify.piece_label(l).alias("rotulo"))


@query("qualification", "SELECT c_custkey AS k, 'Maria da Silva' AS nome, substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 1, 3) || '.' || substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 4, 3) || '.' || substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 7, 3) || '-' || substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 10) AS cpf, 'solteira' AS estado_civil FROM customer")
def qualification(spark, sf_dir):
    t = F.expr("concat('Nome: MARIA DA SILVA', chr(10), 'CPF ', lpad(CAST(c_custkey AS STRING), 11, '0'), chr(10), 'Estado civil: Solteira')")
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), T.qualification(t).alias("q")).select("k", "q.nome", "q.cpf", "q.estado_civil")


@query("size_text", "SELECT o_orderkey AS k, CASE WHEN b < 1024 THEN printf('%.1fB', b) WHEN b / 1024 < 1024 THEN printf('%.1fKB', b / 1024) ELSE printf('%.1fMB', b / 1024 / 1024) END AS tamanho, CASE WHEN k2 < 60 THEN printf('%.1fs', k2) WHEN k2 < 3600 THEN printf('%dm%02ds', CAST(floor(k2 / 60) AS BIGINT), CAST(k2 % 60 AS BIGINT)) ELSE printf('%dh%02dm%02ds', CAST(floor(k2 / 3600) AS BIGINT), CAST(floor(k2 / 60) % 60 AS BIGINT), CAST(k2 % 60 AS BIGINT)) END AS tempo FROM (SELECT o_orderkey, CAST(o_orderkey * 16 AS DOUBLE) AS b, CAST(o_custkey * 4 AS DOUBLE) AS k2 FROM orders)")
def size_text(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), T.size_text(F.col("o_orderkey") * 16).alias("tamanho"), T.time_text(F.col("o_custkey") * 4).alias("tempo"))


# ---------------------------------------------------------------- linkage and whole plans

def _people(spark, sf_dir):
    paper = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS idx", "CASE WHEN s_suppkey % 4 = 0 THEN concat('proc ', lpad(CAST(s_suppkey AS STRING), 7, '0'), '-01.2020.8.05.0001') ELSE '' END AS processo",
        "CASE WHEN s_suppkey % 4 = 1 THEN concat('Pessoa ', lpad(CAST(s_suppkey AS STRING), 6, '0'), ' (APF)') WHEN s_suppkey % 4 = 2 THEN concat('Pesoa ', lpad(CAST(s_suppkey AS STRING), 6, '0')) ELSE 'qwxyz' END AS nome", "'L1' AS livro")
    registry = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS pos", "CAST(s_suppkey AS STRING) AS id", "concat(lpad(CAST(s_suppkey AS STRING), 7, '0'), '-01.2020.8.05.0001') AS processo", "concat('PESSOA ', lpad(CAST(s_suppkey AS STRING), 6, '0')) AS nome")
    return linkage.prepare_paper(paper), linkage.prepare_registry(registry)


@query("link_methods", "SELECT s_suppkey AS idx, CASE s_suppkey % 4 WHEN 0 THEN 'cnj' WHEN 1 THEN 'exato' WHEN 2 THEN 'fuzzy' ELSE 'sem_match' END AS metodo, CASE s_suppkey % 4 WHEN 0 THEN 95 WHEN 1 THEN 92 WHEN 2 THEN 96 ELSE 0 END AS score, s_suppkey % 4 IN (0, 3) AS revisar FROM supplier")
def link_methods(spark, sf_dir):
    return linkage.link(*_people(spark, sf_dir)).select("idx", "metodo", "score", "revisar")


@query("link_counts", """SELECT metodo, count(*) AS n, count(*) FILTER (metodo IN ('cnj', 'sem_match')) AS revisar, count(*) / (SELECT count(*) FROM supplier) * 100 AS percent
FROM (SELECT CASE s_suppkey % 4 WHEN 0 THEN 'cnj' WHEN 1 THEN 'exato' WHEN 2 THEN 'fuzzy' ELSE 'sem_match' END AS metodo FROM supplier) GROUP BY 1""")
def link_counts(spark, sf_dir):
    return linkage.link_summary(linkage.link(*_people(spark, sf_dir)))


PAGES = ["CAST(o_custkey AS STRING) AS numero", "o_orderkey AS ordem", f"{TEXTS[1].removesuffix(' AS t')} AS text"]


def templated_pages(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "orders").selectExpr(*PAGES)
    return rows.select("numero", F.row_number().over(Window.partitionBy("numero").orderBy("ordem")).alias("pag"), "text")


def flagship_sql() -> str:
    """Pages to cleaned, typed pages; the ordered fold as a recursion over a case's pages; events, ladders and people."""
    page = TEXTS[1].removesuffix(" AS t")
    first = "(SELECT k, CASE WHEN {0} THEN regexp_extract_all(t, {1}, 1)[-1] ELSE nullif(coalesce(regexp_extract_all(t, {2}, 1)[-1], ''), '') END AS num FROM raw)".format(matches("t", V.DOC_ID_WITH_PAGE, "i"), _PAIRED, _ALONE)
    full, tracked = ", ".join(f"'{t}'" for t in V.FULL_PIECES), ", ".join(f"'{t}'" for t in LADDER)
    days = "regexp_extract_all({0}, '\\b\\d{{2}}/\\d{{2}}/\\d{{4}}\\b')"
    before, now = days.format("f.head"), days.format("left(p.texto, 1500)")
    return f"""WITH RECURSIVE raw AS (SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS numero, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pag, {page} AS t FROM orders),
clean AS (SELECT k, {_cleaned_sql('t')} AS t FROM raw),
kind AS ({classify_sql('clean', 'k', 't')}),
typed AS (SELECT raw.numero, raw.pag, CASE WHEN kind.confianca < 0.3 AND kind.tipo IN ({full}) THEN 'DOC' ELSE kind.tipo END AS tipo, clean.t AS texto, ids.num FROM raw JOIN clean USING (k) JOIN kind USING (k) JOIN {first} ids USING (k) WHERE length(clean.t) >= 30),
pages AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY numero ORDER BY pag) AS n FROM typed WHERE tipo NOT IN ({', '.join("'" + t + "'" for t in V.DROPPED_PIECES)})),
fold AS (SELECT numero, n, 0 AS ordem, tipo, pag, CASE WHEN num IS NULL THEN [] ELSE [num] END AS ids, left(texto, 1500) AS head FROM pages WHERE n = 1
UNION ALL SELECT numero, n, CASE WHEN j THEN ordem ELSE ordem + 1 END, CASE WHEN j THEN tipo ELSE own END, pag, CASE WHEN num IS NULL THEN CASE WHEN j THEN ids ELSE [] END WHEN j THEN ids || [num] ELSE [num] END, CASE WHEN j THEN left(head || E'\\n\\n' || left(texto, 1500), 1500) ELSE left(texto, 1500) END
FROM (SELECT p.numero, p.n, f.ordem, f.tipo, p.tipo AS own, p.pag, f.ids, p.num, f.head, p.texto, p.pag - f.pag <= 1 AND ((f.tipo = p.tipo AND coalesce(list_contains(f.ids, p.num), false))
OR (NOT (len(f.ids) > 0 AND p.num IS NOT NULL AND NOT coalesce(list_contains(f.ids, p.num), false)) AND CASE WHEN f.tipo = p.tipo THEN NOT (len({before}) > 0 AND len({now}) > 0 AND NOT list_has_any({before}, {now})) ELSE p.tipo = 'DOC' AND f.tipo IN ({full}) END)) AS j
FROM fold f JOIN pages p ON p.numero = f.numero AND p.n = f.n + 1)),
pieces AS (SELECT DISTINCT numero, ordem, tipo FROM fold),
people AS (SELECT numero, least(count(DISTINCT c), 10) AS n_cpfs FROM (SELECT numero, unnest(regexp_extract_all(texto, {lit(re2(*V.CPF))}, 1)) AS c FROM pages) GROUP BY numero)
SELECT numero, {_when(pieces.PHASES, pieces.NO_PHASE)} AS fase_aparente, {_when(pieces.STATUSES, pieces.NO_STATUS)} AS provavel_status_cautelar, CAST(count(*) FILTER (tipo IN ({tracked})) AS INT) AS n_eventos, count(*) AS pecas, count(*) FILTER (tipo IN ({full})) AS completas, CAST(any_value(n_cpfs) AS INT) AS n_cpfs
FROM pieces JOIN people USING (numero) GROUP BY numero"""


@query("case_flags", flagship_sql())
def case_flags(spark, sf_dir):
    """The flagship: pages to cleaned, typed pages, folded into pieces, to events, phase, status and people."""
    return extract_cases(templated_pages(spark, sf_dir)).select("numero", "fase_aparente", "provavel_status_cautelar", F.size("eventos").alias("n_eventos"), "pecas", "completas", F.size("dados_pessoais.cpfs").alias("n_cpfs"))


@query("rendered_cases")
def rendered_cases(spark, sf_dir):
    from .extraction import render_cases

    return render_cases(templated_pages(spark, sf_dir))


