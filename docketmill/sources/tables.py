"""Readers: case and registry tables, JSON results, markdown status, files, command texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.regex import first, strip
from ..operators.dedup import drop_blank_keys, first_wins


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) has something, by the file system that the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def json_or_default(spark: SparkSession, path: str, schema: str, default: DataFrame | None = None) -> DataFrame:
    """The rows of a JSON file; where it is missing or broken the default, an empty table if there is none."""
    kind = T.StructType.fromDDL(schema)
    if exists(spark, path):
        held = spark.read.text(path, wholetext=True).select(F.from_json("value", T.ArrayType(kind)).alias("r"))
        if held.filter("r IS NOT NULL").take(1):
            return held.select(F.explode("r").alias("r")).select("r.*")
    return spark.createDataFrame([], kind) if default is None else default


def broken_json(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """file: the JSON files of a folder that cannot be parsed."""
    if not exists(spark, f"{folder.rstrip('/')}/{pattern}"):
        return spark.createDataFrame([], "file string")
    rows = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return rows.filter(F.expr("try_parse_json(value)").isNull()).select("file")


# The prompt files of the class codes.
PROMPT_FILES = {c: f"prompt_{c}.md" for c in ("APOrd", "APSum", "APSumss", "IP", "Juri", "TCO", "outros")}


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    """chave and prompt for every class code; empty text where its file is missing."""
    keys = spark.createDataFrame(list(PROMPT_FILES.items()), "chave string, _file string")
    if not exists(spark, f"{folder.rstrip('/')}/prompt_*.md"):
        return keys.select("chave", F.lit("").alias("prompt"))
    texts = spark.read.text(f"{folder.rstrip('/')}/prompt_*.md", wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("_file"), F.col("value").alias("_text"))
    return keys.join(texts, "_file", "left").select("chave", F.coalesce("_text", F.lit("")).alias("prompt"))


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Files of a folder: path, length, modificationTime, content. A missing folder has none."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def text_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """stem and path of the .txt and .md files of a folder."""
    listed = files(spark, folder, "*.{txt,md}").select("path")
    return listed.select(F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1).alias("stem"), "path")


def _positions(df: DataFrame) -> DataFrame:
    """pos: the order of rows by file name, and in a file by their place in it.

    Ids rise with the partitions, which Spark orders by size; so a file's rank among the names goes in front
    (a few thousand names at most, 2^20, then 2^43 rows a file)."""
    spark, names = df.sparkSession, sorted(df.inputFiles())
    if len(names) < 2:
        return df.withColumn("pos", F.monotonically_increasing_id())
    ranks = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "_name string, _rank long")
    own = df.withColumn("_name", F.col("_metadata.file_path")).withColumn("_at", F.monotonically_increasing_id())
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    ranks = ranks.withColumn("_name", plain("_name"))
    joined = own.withColumn("_name", plain("_name")).join(F.broadcast(ranks), "_name", "left")
    return joined.withColumn("pos", F.coalesce("_rank", F.lit(0)) * F.lit(1 << 43) + F.col("_at") % F.lit(1 << 43)).drop("_name", "_rank", "_at")


def case_table(spark: SparkSession, path: str, key: str = "Número do Processo") -> DataFrame:
    """Comma-separated with a header; keys trimmed, blank ones dropped, the first row of each stays."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"`{key}` string, pos long")
    rows = _positions(spark.read.csv(path, header=True, sep=",", quote='"', escape='"', multiLine=True))
    return first_wins(drop_blank_keys(rows, key), [key], ["pos"])


def registry_table(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated; pos, id, processo, classe, nome, assunto."""
    rows = _positions(spark.read.csv(path, header=True, sep=";", quote='"', escape='"', multiLine=True))
    named = {"id": "idProcesso", "processo": "numeroProcesso", "classe": "classeJudicial", "nome": "poloPassivo", "assunto": "assuntoPrincipal"}
    col = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) if c in rows.columns else F.lit("")
    return rows.select("pos", *[col(c).alias(k) for k, c in named.items()]).filter("nome <> ''")


def json_rows(spark: SparkSession, folder: str, schema: str | T.StructType, pattern: str = "*.json") -> DataFrame:
    """Objects of JSON files, arrays spread; unreadable files are left out. Adds file and pos (order in the file)."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not exists(spark, f"{folder.rstrip('/')}/{pattern}"):
        return spark.createDataFrame([], T.StructType([*kind.fields, T.StructField("file", T.StringType()), T.StructField("pos", T.LongType())]))
    rows = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    # An object reads as an array of one; what cannot be parsed is null and leaves no row.
    rows = rows.select("file", F.posexplode(F.from_json("value", T.ArrayType(kind))).alias("pos", "_r")).filter("_r IS NOT NULL")
    return rows.select("_r.*", "file", F.col("pos").cast("long").alias("pos"))


def first_records(rows: DataFrame, key: str) -> DataFrame:
    """The first record of each non-blank key by file name and position."""
    return first_wins(rows.filter(F.trim(F.coalesce(F.col(key), F.lit(""))) != ""), [key], ["file", "pos"])


def control_or_files(spark: SparkSession, control: str, folder: str, schema: str, pattern: str) -> DataFrame:
    """The values of a control file's map `processos`; where it is missing or broken the files of the folder."""
    if exists(spark, control):
        got = spark.read.schema(f"processos map<string, struct<{_struct(schema)}>>, _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(control)
        ok = got.filter("_corrupt IS NULL AND processos IS NOT NULL")
        if ok.take(1):
            return ok.select(F.explode(F.map_values("processos")).alias("v")).select("v.*")
    return json_rows(spark, folder, schema, pattern).drop("file", "pos")


def _struct(schema: str) -> str:
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema).fields)


def status_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """numero_processo, arquivo_md, status_cautelar of markdown files that have both."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "numero_processo string, arquivo_md string, status_cautelar string")
    rows = spark.read.text(f"{folder.rstrip('/')}/*.md", wholetext=True).withColumn("arquivo_md", F.input_file_name())
    return status_rows(rows.select("arquivo_md", F.col("value").alias("text")))


def status_rows(rows: DataFrame) -> DataFrame:
    line = F.get(F.split("text", "\n"), F.lit(0))
    key = F.when(line.startswith("# "), strip(F.substring(line, 3, 1 << 20))).otherwise("")
    found = strip(first(F.col("text"), r"\*\*Status[^*\n]*\*\*:?\s*([^\n]+)", "i"))
    return rows.select(key.alias("numero_processo"), "arquivo_md", found.alias("status_cautelar")).filter("numero_processo <> '' AND status_cautelar <> ''")


def eligible(rows: DataFrame, pattern: str = r"ATIVA|VERIFICAR|PREVENTIVA") -> DataFrame:
    return rows.filter(F.col("status_cautelar").rlike(f"(?i){pattern}"))


def csv_union(spark: SparkSession, paths: list[str], order_by: str | None = None) -> DataFrame:
    """The rows of CSV files with arquivo_origem; a file whose columns the first one lacks is an error."""
    frames = []
    for p in sorted(paths):
        f = spark.read.csv(p, header=True)
        if frames and set(f.columns) - set(frames[0].columns):
            raise ValueError(f"columns that the first file lacks: {p}")
        frames.append(f.withColumn("arquivo_origem", F.lit(p.rsplit("/", 1)[-1])))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.orderBy(order_by) if order_by else out


def command_blocks(texts: DataFrame, text: str = "text") -> DataFrame:
    """Blocks that begin with `# === CMD n`: num (null without one), pos and bloco."""
    parts = F.filter(F.split(text, r"(?m)(?=^# === CMD )"), lambda b: F.trim(b).startswith("# === CMD"))
    rows = texts.select(F.posexplode(parts).alias("pos", "bloco"))
    return rows.withColumn("num", F.regexp_extract("bloco", r"# === CMD\s+(\d+)", 1).try_cast("int"))


def blocks_of(commands: DataFrame, blocks: DataFrame) -> DataFrame:
    """commands (num, pos) with the block of their number, else that of their position."""
    by_num = blocks.filter("num IS NOT NULL").groupBy("num").agg(F.min_by("bloco", "pos").alias("_a"))
    by_pos = blocks.select("pos", F.col("bloco").alias("_b"))
    return commands.join(by_num, "num", "left").join(by_pos, "pos", "left").withColumn("bloco", F.coalesce("_a", "_b")).drop("_a", "_b")
