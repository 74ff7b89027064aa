"""Logs: JSON lines of sessions, audit lines of key=value parts, Markdown logs with dated headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Session records. `content` is a text or a list of blocks, so it is kept as JSON.
SESSION = "type string, timestamp string, message struct<role string, model string, content string, usage struct<input_tokens long, output_tokens long, cache_creation_input_tokens long, cache_read_input_tokens long>>"
EVAL = "ts string, category string, model string, context_chars int, output_chars int, duration_ms int, success boolean, est_tokens_saved int"
BLOCK = "array<struct<type string, text string, name string, input map<string,string>, content string, is_error boolean>>"


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of well-formed lines, with path; malformed lines are left out."""
    rows = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line"), "value")
    return parsed_lines(rows, schema)


def parsed_lines(rows: DataFrame, schema: str) -> DataFrame:
    """path, line and the fields of the schema of well-formed lines; rows: path, line, value."""
    # the corrupt column must be read with the others, so the text is parsed here and malformed lines are null
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = rows.where(F.trim("value") != "").withColumn("r", parsed).where("r IS NOT NULL AND r._corrupt IS NULL")
    return out.select("path", "line", "r.*").drop("_corrupt")


def sessions(records: DataFrame) -> DataFrame:
    """By session file (sub-agents' left out): start and end in the file's order, first model, calls and tokens by kind; newest first is up to the reader."""
    u = "message.usage"
    n = lambda f: F.coalesce(F.col(f"{u}.{f}"), F.lit(0))
    rows = records.where(~F.col("path").contains("subagents"))
    used = n("input_tokens") + n("output_tokens") + n("cache_creation_input_tokens") + n("cache_read_input_tokens") > 0
    ts = F.try_to_timestamp("timestamp")
    out = rows.groupBy("path").agg(
        F.min_by(ts, F.when(ts.isNotNull(), F.col("line"))).alias("start"),
        F.max_by(ts, F.when(ts.isNotNull(), F.col("line"))).alias("end"),
        F.min_by("message.model", F.when(F.col("message.model").isNotNull(), F.col("line"))).alias("model"),
        F.count_if(used).alias("calls"),
        *[F.sum(n(f)).alias(f) for f in ("input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens")],
    )
    return out.where("input_tokens + output_tokens + cache_creation_input_tokens + cache_read_input_tokens > 0")


def by_model(records: DataFrame) -> DataFrame:
    """By session and model: calls and tokens."""
    u = "message.usage"
    n = lambda f: F.coalesce(F.col(f"{u}.{f}"), F.lit(0))
    rows = records.where(F.col(u).isNotNull())
    return rows.groupBy("path", F.coalesce("message.model", F.lit("unknown")).alias("model")).agg(F.count("*").alias("calls"), F.sum(n("input_tokens")).alias("input"), F.sum(n("output_tokens")).alias("output"), F.sum(n("cache_creation_input_tokens")).alias("cache_write"), F.sum(n("cache_read_input_tokens")).alias("cache_read"))


def content_text(content: Column) -> Column:
    """The text of a content: itself, or the text blocks of a list joined by spaces."""
    blocks = F.from_json(content, BLOCK)
    texts = F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"])
    return F.when(F.left(F.ltrim(content), F.lit(1)) == "[", F.array_join(texts, " ")).otherwise(content)


def blocks(records: DataFrame) -> DataFrame:
    """path, line, pos, role, kind, name, target, text, error of every content block; kind: text, tool or result."""
    rows = records.select("path", "line", F.col("message.role").alias("role"), F.posexplode(F.from_json("message.content", BLOCK)).alias("pos", "b"))
    kind = F.when(F.col("b.type") == "tool_use", "tool").when(F.col("b.type") == "tool_result", "result").otherwise("text")
    target = F.coalesce(F.try_element_at("b.input", F.lit("file_path")), F.try_element_at("b.input", F.lit("path")), F.try_element_at("b.input", F.lit("command")))
    return rows.select("path", "line", "pos", "role", kind.alias("kind"), F.col("b.name").alias("name"), target.alias("target"), F.coalesce("b.text", "b.content").alias("text"), F.coalesce("b.is_error", F.lit(False)).alias("error"))


def user_messages(records: DataFrame, least: int = 10, chars: int = 2000, most: int = 200) -> DataFrame:
    """path, line, text: the first messages of users in each session, of more than `least` characters, cut to `chars`."""
    rows = records.where("message.role = 'user'").select("path", "line", F.trim(content_text(F.col("message.content"))).alias("text")).where(F.length("text") > least)
    place = F.row_number().over(Window.partitionBy("path").orderBy("line"))
    return rows.withColumn("place", place).where(F.col("place") <= most).select("path", "line", F.left("text", F.lit(chars)).alias("text"))


def audit(lines: DataFrame, column: str = "value") -> DataFrame:
    """fields: a map of the key=value parts; parts that begin with [ are left out, the last of equal keys counts."""
    parts = F.filter(F.split(F.trim(column), " +"), lambda p: p.contains("=") & ~p.startswith("["))
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.regexp_replace(p, "^[^=]*=", "").alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return lines.withColumn("fields", F.map_from_entries(last))


def dated_entries(files: DataFrame) -> DataFrame:
    """path, pos, ts, severity, kind, detail: `- **SEVERITY** [kind] detail` lines under the last dated heading before them.

    files: path, text. Entries before any heading have no ts.
    """
    rows = files.select("path", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    heading = F.nullif(F.regexp_extract("line", "^#+\\s*(\\d{4}-\\d{2}-\\d{2}(?: \\d{2}:\\d{2})?)", 1), F.lit(""))
    carried = F.last(heading, ignorenulls=True).over(Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    entry = "^- \\*\\*(\\w+)\\*\\*\\s*\\[([^\\]]+)\\]\\s*(.*)$"
    field = lambda i: F.regexp_extract("line", entry, i)
    return rows.withColumn("ts", carried).where(F.col("line").rlike(entry)).select("path", "pos", "ts", field(1).alias("severity"), field(2).alias("kind"), field(3).alias("detail"))


def state(spark: SparkSession, path: str) -> DataFrame:
    """A state document: one JSON value over several lines."""
    return spark.read.option("multiLine", True).json(path)
