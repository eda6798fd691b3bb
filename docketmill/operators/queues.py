"""Work queues: enrichment, done filters, batches, sequential ids, packing and progress."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import classify, scoring
from ..functions.text import file_of_case_number
from .durable import durable

# Batch sizes with and without text, of extraction, and the packing targets.
WITH_TEXT, WITHOUT_TEXT, EXTRACTION = 3, 15, 5
PACK_TARGET, LARGE_GROUP = 6, 6


def global_rank(df: DataFrame, order: list[Column], within: list[str] | None = None, name: str = "rank", buckets: int | None = None) -> DataFrame:
    """1-based positions by order inside each group of `within` (all rows where it is empty).

    A range partitioning sorts the rows over all tasks; each row's position is its place in its
    partition plus the sizes of the partitions before, so no group has to fit one task.
    """
    within = within or []
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = {c.lower() for c in df.columns}
    part, at, nth, size, base = (next(c for c in (stem + "_" * k for k in range(99)) if c not in taken) for stem in ("_p", "_i", "_r", "_n", "_before"))
    sorted_ = df.repartitionByRange(n, *within, *order).sortWithinPartitions(*within, *order)
    # Written once: a second evaluation could draw other range bounds.
    placed = durable(sorted_.withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id()))
    local = placed.withColumn(nth, F.row_number().over(Window.partitionBy(part, *within).orderBy(at)))
    sizes = placed.groupBy(part, *within).agg(F.count("*").alias(size))
    before = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn(base, F.coalesce(F.sum(size).over(before), F.lit(0))).drop(size)
    cond = None
    a, b = local.alias("a"), sizes.alias("b")
    for c in [part, *within]:
        term = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        cond = term if cond is None else cond & term
    return a.join(b, cond).select(*[F.col(f"a.{c}") for c in df.columns], (F.col(f"a.{nth}") + F.col(f"b.{base}")).alias(name))


def enrich_cases(cases: DataFrame, texts: DataFrame, done: DataFrame) -> DataFrame:
    """The queue's items from cases (numero, classe, assunto, tarefa, dias, ultima_mov, pos), the stems of the
    texts at hand (stem) and the numbers done (numero)."""
    urgent = scoring.urgency(F.col("dias"), F.col("assunto"), F.col("classe"))
    items = cases.withColumn("_u", urgent).select(
        "numero",
        classify.class_code(F.col("classe")).alias("classe"),
        "assunto",
        "tarefa",
        F.col("dias").alias("dias_parado"),
        "ultima_mov",
        F.col("_u.urgencia").alias("urgencia"),
        F.col("_u.score").alias("score"),
        file_of_case_number(F.col("numero")).alias("txt_arquivo"),
        "pos",
    )
    stems = texts.select(F.col("stem").alias("_stem")).distinct().withColumn("tem_pdf", F.lit(True))
    items = items.join(stems, F.regexp_replace("txt_arquivo", r"\.[^.]*$", "") == F.col("_stem"), "left").drop("_stem")
    marks = done.select(F.col("numero").alias("_n")).distinct().withColumn("ja", F.lit(True))
    items = items.join(marks, F.col("numero") == F.col("_n"), "left").drop("_n")
    return items.fillna(False, ["tem_pdf", "ja"])


def fixed_batches(items: DataFrame, group: str, order: list[Column], has_text: str, sizes: tuple[int, int] = (WITH_TEXT, WITHOUT_TEXT)) -> DataFrame:
    """items with place (in its group) and num, the running number of its batch: text-bearing groups first.

    Null groups come last; where it is unknown whether there is text, groups of their own follow, of the size without."""
    keyed = items.withColumn("_t", F.when(F.col(has_text), 0).when(~F.col(has_text), 1).otherwise(2))
    placed = global_rank(keyed, order, ["_t", group], "place")
    size = F.when(F.col(has_text), sizes[0]).otherwise(sizes[1])
    placed = placed.withColumn("_c", F.floor((F.col("place") - 1) / size).cast("int"))
    counts = placed.groupBy("_t", group).agg((F.max("_c") + 1).alias("_k"))
    # One row for each group: prompts, a handful.
    before = Window.orderBy("_t", F.asc_nulls_last(group)).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_base", F.coalesce(F.sum("_k").over(before), F.lit(0))).drop("_k")
    a, b = placed.alias("a"), counts.alias("b")
    joined = a.join(b, (F.col("a._t") == F.col("b._t")) & F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}")))
    num = (F.col("b._base") + F.col("a._c") + 1).cast("int").alias("num")
    return joined.select(*[F.col(f"a.{c}") for c in items.columns], F.col("a.place"), num)


def chunks(items: DataFrame, order: list[Column], size: int = EXTRACTION) -> DataFrame:
    """items with num: runs of `size` in order."""
    return global_rank(items, order, name="place").withColumn("num", (F.floor((F.col("place") - 1) / size) + 1).cast("int"))


def sequential_ids(groups: DataFrame, prefix: str, order: list[Column], name: str = "group_id") -> DataFrame:
    """prefix_001, prefix_002, … in order; the counter runs on within a prefix."""
    return global_rank(groups, order, [prefix], "_n").withColumn(name, F.concat(F.col(prefix), F.lit("_"), F.format_string("%03d", F.col("_n")))).drop("_n")


def name_order(name: Column) -> list[Column]:
    """Sort keys: names with a number by their first one, then the others by alphabet."""
    number = F.regexp_extract(name, r"(\d+)", 1)
    return [(number == "").cast("int"), F.when(number != "", number.cast("decimal(38,0)")), F.when(number == "", name)]


def adaptive_packing(groups: DataFrame, by: list[str], order: str, size: str, target: int = PACK_TARGET, large: int = LARGE_GROUP) -> DataFrame:
    """groups with num, the number of its pack inside each of `by`: ordered first-fit up to the target, groups of
    `large` and more alone.

    An ordered fold needs the rows of one of `by` in order in one task; they stream through it with three numbers of
    state, so no array of them is held. Sizes that are null count as 0.
    """
    rows = groups.repartition(*by).sortWithinPartitions(*by, order)

    def run(batches):
        now, num, held = None, 0, 0
        for batch in batches:
            out = []
            for key, n in zip(zip(*(batch.column(c).to_pylist() for c in by)), batch.column(size).to_pylist()):
                n = int(n or 0)
                if key != now:
                    now, num, held = key, 0, 0
                fits = n < large and 0 < held <= target - n
                num += not fits
                held = 0 if n >= large else held + n if fits else n
                out.append(num)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "num"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("num", T.IntegerType())]))


def pending_split(files: DataFrame, cache: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """files (numero, cache_key) with hit: the cached key is equal and the output exists."""
    known = cache.select("numero", F.col("cache_key").alias("_old"))
    there = outputs.select("numero").distinct().withColumn("_there", F.lit(True))
    hit = F.coalesce((F.col("cache_key") == F.col("_old")) & F.col("_there"), F.lit(False)) & F.lit(not force)
    return files.join(known, "numero", "left").join(there, "numero", "left").withColumn("hit", hit).drop("_old", "_there")


def cache_status(cache: DataFrame, outputs: DataFrame, version: str) -> DataFrame:
    """cache with status: invalid without a key of this version, else valid or orphan by its output."""
    there = outputs.select("numero").distinct().withColumn("_there", F.lit(True))
    ok = F.coalesce(F.col("cache_key").endswith("_" + version), F.lit(False))
    return cache.join(there, "numero", "left").withColumn("status", F.when(~ok, "invalid").when(F.col("_there"), "valid").otherwise("orphan")).drop("_there")


def undone(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return items.join(done.select(key), key, "left_anti")


def undone_commands(commands: DataFrame, done: DataFrame, command: str, item: str) -> DataFrame:
    """Commands of which at least one item is not done."""
    return commands.join(done.select(item), item, "left_anti").select(command).distinct()


def in_range(commands: DataFrame, num: str, first: int = 0, last: int = 0, most: int = 0) -> DataFrame:
    """Numbers from first to last, 0 for open; then the first `most` of them."""
    kept = commands.filter((F.col(num) >= first) & ((F.lit(last) == 0) | (F.col(num) <= last)))
    return kept.orderBy(num).limit(most) if most else kept


def completion(commands: DataFrame, results: DataFrame, command: str, item: str) -> DataFrame:
    """Per command: n, done and status OK, PARCIAL or ERRO. results: item and broken (true: unreadable)."""
    r = results.groupBy(item).agg(F.max(F.col("broken").cast("int")).alias("_bad"))
    got = commands.join(r, item, "left").groupBy(command).agg(
        F.count("*").alias("n"), F.count_if(F.col("_bad") == 0).alias("done"), F.coalesce(F.max("_bad"), F.lit(0)).alias("_bad")
    )
    status = F.when(F.col("_bad") == 1, "ERRO").when(F.col("done") == F.col("n"), "OK").when(F.col("done") > 0, "PARCIAL").otherwise("ERRO")
    return got.withColumn("status", status).drop("_bad")


def loosely_complete(commands: DataFrame, triage: DataFrame, analyses: DataFrame, command: str, item: str) -> DataFrame:
    """Per command: whether its triage exists, or any analysis of its items."""
    t = triage.select(command).distinct().withColumn("_t", F.lit(True))
    a = analyses.select(item).distinct().withColumn("_a", F.lit(True))
    got = commands.join(a, item, "left").join(t, command, "left")
    return got.groupBy(command).agg(F.coalesce(F.bool_or(F.coalesce("_t", F.lit(False)) | F.coalesce("_a", F.lit(False))), F.lit(False)).alias("complete"))


def groups_done(groups: DataFrame, analyses: DataFrame, control: DataFrame, required: list[str]) -> DataFrame:
    """groups (group_id) with done: an analysis with all required fields, or an entry of the control table."""
    whole = analyses.filter(" AND ".join(f"{c} IS NOT NULL" for c in required)).select("group_id")
    ok = whole.unionByName(control.select("group_id")).distinct().withColumn("done", F.lit(True))
    return groups.join(ok, "group_id", "left").fillna(False, ["done"])


def progress(total: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: total, done and percent (0 of nothing)."""
    marked = total.select(key).distinct().join(done.select(key).distinct().withColumn("_d", F.lit(1)), key, "left")
    return marked.agg(F.count("*").alias("total"), F.count("_d").alias("done")).withColumn("percent", F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("done") / F.col("total") * 100))


def checkpoint_state(log: DataFrame) -> dict[str, DataFrame]:
    """From an append-only log (cmd, item, data, arquivo): commands done, last command, items (last wins)."""
    from .dedup import last_wins

    return {
        "comandos_concluidos": log.select("cmd").distinct(),
        "ultimo_comando": log.agg(F.max("cmd").alias("ultimo_comando")),
        "processos_analisados": last_wins(log.filter("item IS NOT NULL"), ["item"], ["data", "cmd"]),
    }


def sessions(log: DataFrame) -> DataFrame:
    """Sessions (inicio, fim) with minutes; whole days do not count, as in the reference format."""
    return log.withColumn("minutos", F.floor(F.pmod(F.unix_timestamp("fim") - F.unix_timestamp("inicio"), F.lit(86400)) / 60).cast("int"))


def mark_done(spark, cmd: int, items: list[str], result: str, when: str) -> DataFrame:
    """Rows for the append-only log of checkpoint_state(): a command, by hand or by a run, with its items.

    A command without items is one row with a null item; a partial one lists the items that are done."""
    rows = [(cmd, i, when, result) for i in items] or [(cmd, None, when, result)]
    return spark.createDataFrame(rows, "cmd long, item string, data string, arquivo string")


def command_lists(commands: DataFrame, log: DataFrame) -> DataFrame:
    """Per command (cmd, item): total, done, and whether it is concluded or partial by the log."""
    done = log.select("item").distinct().withColumn("_d", F.lit(1))
    got = commands.join(done, "item", "left").groupBy("cmd").agg(F.count("*").alias("total"), F.count("_d").alias("done"))
    return got.withColumns({"concluido": F.col("done") == F.col("total"), "parcial": (F.col("done") > 0) & (F.col("done") < F.col("total"))})


def _place(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def reset_queue(spark, paths: list[str]) -> list[str]:
    """Delete the queue's and checkpoint's tables; returns those that were there. Results and control stay."""
    gone = []
    for path in paths:
        place, store = _place(spark, path)
        if store.exists(place) and store.delete(place, True):
            gone.append(path)
    return gone


def reset_control(spark, path: str, stamp: str, confirmed: bool = False) -> str | None:
    """Set the control table aside under a name with the stamp; returns that name. Nothing without confirmation or table."""
    place, store = _place(spark, path)
    if not confirmed or not store.exists(place):
        return None
    stem, dot, extension = path.rstrip("/").rpartition(".") if "." in path.rstrip("/").rsplit("/", 1)[-1] else (path.rstrip("/"), "", "")
    backup = f"{stem}.bkp_{stamp}{dot}{extension}"
    if not store.rename(place, _place(spark, backup)[0]):
        raise OSError(f"cannot set {path} aside")
    return backup
