"""File sources (SR1, SR4-SR6, SR8, SR9): landing JSON, table streams, rule
documents, calibration text blocks, delimited text and XML features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType, StructField, StructType)

from ..operators.chunks import carry
from .sinks import APPENDED

# Landing envelope and its JSON body (one reading per array element).
LANDING_SCHEMA = StructType([StructField("source_module", StringType()), StructField("body", StringType())])
BODY_SCHEMA = ArrayType(StructType([
    StructField("nodeId", StringType()), StructField("displayName", StringType()),
    StructField("value", StructType([StructField("value", DoubleType()), StructField("timestamp", StringType()),
                                     StructField("statusCode", StringType())]))]))

# Rule document layout (one JSON object per rule, nested conditions).
CONDITION_DOC = StructType([
    StructField("condition_id", IntegerType()), StructField("condition_name", StringType()),
    StructField("asset_id", ArrayType(StringType())), StructField("parameter", StringType()),
    StructField("operator", StringType()), StructField("class", IntegerType()),
    StructField("threshold", DoubleType()), StructField("duration", IntegerType()),
    StructField("wire", StringType()), StructField("function", StringType()),
    StructField("wire_length_from", StringType()), StructField("wire_length_to", StringType()),
    StructField("rule_run_frequency", IntegerType()), StructField("sensor_type", StringType()),
    StructField("baseline_time", IntegerType()), StructField("threshold_unit", StringType()),
    StructField("path", StringType())])
RULE_DOC = StructType([
    StructField("rule_id", IntegerType()), StructField("rule_name", StringType()),
    StructField("tenant_id", StringType()), StructField("join_condition", StringType()),
    StructField("severity", StringType()), StructField("risk_register_controls", ArrayType(IntegerType())),
    StructField("operation", StringType()), StructField("rule_type", StringType()),
    StructField("conditions", ArrayType(CONDITION_DOC))])


def read_landing(spark: SparkSession, path: str, schema: StructType = LANDING_SCHEMA,
                 streaming: bool = True) -> DataFrame:
    """SR1: JSON landing files with an explicit schema (stream or batch)."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("json").schema(schema).load(path)


def landing_to_bronze(df: DataFrame, reset_date: str | None = None) -> DataFrame:
    """PJ1/PJ2/PJ3: body (JSON array text) -> one row per reading: ``tag_id, value,
    timestamp, quality`` (+ ``last_updated_date``). Parsed with ``from_json``
    (brackets or braces inside values stay intact), bad timestamps become null."""
    rows = df.select(F.explode(F.from_json("body", BODY_SCHEMA)).alias("r"))
    out = rows.select(F.col("r.displayName").alias("tag_id"), F.col("r.value.value").alias("value"),
                      F.try_to_timestamp(F.col("r.value.timestamp")).alias("timestamp"),
                      F.col("r.value.statusCode").alias("quality"),
                      F.current_timestamp().alias("last_updated_date"))
    if reset_date is not None:
        out = out.filter(F.col("timestamp") > F.lit(reset_date).cast("timestamp"))
    return out


def read_stream_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
                      max_files: int | None = None) -> DataFrame:
    """SR4: stream a file table that is only appended to (every new file)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def read_appended(spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = None,
                  day_col: str = "day") -> DataFrame:
    """SR4: change-tolerant stream over a day-partitioned table: every row that ``sinks.append_days`` appended, once.

    Days that were rewritten (``replace_days``, ``upsert_days``, ``refresh_days``) and days that were
    dropped are passed over: rewritten files carry another name, and appended files of a rewritten
    day are found, under their old name, where the rewrite moved them. Files are told apart by name alone, so a
    moved file is not read twice. ``schema`` is the appended rows' (without the day).
    """
    names = f"{path.rstrip('/')}{{,_appended}}/{day_col}=*"
    r = (spark.readStream.schema(schema).option("pathGlobFilter", f"{APPENDED}-*").option("fileNameOnly", "true")
              .option("maxFileAge", "36500d").option("ignoreMissingFiles", "true"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(names)


def landing_errors(df: DataFrame) -> DataFrame:
    """Landing messages whose body is no array of readings: ``source_module, body,
    error``. ``landing_to_bronze`` has no row for them; this is where they go."""
    parsed = F.from_json("body", BODY_SCHEMA)
    bad = parsed.isNull() | F.exists(parsed, lambda r: r["displayName"].isNull() & r["value"].isNull())
    return df.filter(bad).withColumn("error", F.lit("malformed body"))


def read_rules(spark: SparkSession, paths, schema: StructType = RULE_DOC) -> DataFrame:
    """SR5: rule documents with an explicit nested schema, plus the source file name."""
    return spark.read.schema(schema).option("multiLine", "true").json(paths).withColumn(
        "file_name", F.input_file_name())


def parse_block_text(lines: DataFrame, start_re: str, end_re: str, file_col: str = "file",
                     line_no: str = "line_no", text: str = "value") -> DataFrame:
    """SR6: calibration text: rows between a start marker line and an end marker
    line are a block; block ids by a running count of start markers per file.

    ``lines`` holds (file, line_no, value), e.g. from ``read_text_lines``. Markers
    are counted inside pieces of 10,000 lines and carried over a file's pieces
    (a window over one row per piece), so a long file is not one task.
    Returns the lines inside blocks with ``block_id`` (1-based per file).
    """
    piece = lines.withColumn("_chunk", F.floor(F.col(line_no) / 10_000).cast("long"))
    piece = (piece.withColumn("_is_start", F.coalesce(F.col(text).rlike(start_re), F.lit(False)))
                  .withColumn("_is_end", F.coalesce(F.col(text).rlike(end_re), F.lit(False))))
    w = Window.partitionBy(file_col, "_chunk").orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    marks = [("_s", "_is_start"), ("_e", "_is_end")]
    t = piece.select("*", *[F.sum(F.col(m).cast("int")).over(w).alias(n) for n, m in marks])
    sums = piece.groupBy(file_col, "_chunk").agg(*[F.sum(F.col(m).cast("int")).alias(n) for n, m in marks])
    sums = carry(sums, [file_col], {f"{n}_before": F.sum(n) for n, _ in marks}).select(
        F.col(file_col).alias("_file"), F.col("_chunk").alias("_piece"), "_s_before", "_e_before")
    t = t.join(sums, F.col(file_col).eqNullSafe(F.col("_file")) & (F.col("_chunk") == F.col("_piece")), "inner")
    for n, _ in marks:
        t = t.withColumn(n, F.col(n) + F.coalesce(F.col(f"{n}_before"), F.lit(0)))
    # inside block k: k starts seen, fewer than k ends seen before this line
    inside = (F.col("_s") > 0) & ((F.col("_e") - F.col("_is_end").cast("int")) < F.col("_s")) \
        & ~F.col("_is_start") & ~F.col("_is_end")
    return t.filter(inside).select(file_col, line_no, F.col("_s").alias("block_id"), text)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """SR6: text files as (file, line_no, value), line numbers from 1 per file.

    Files are read in Spark's splits, so a file of any size is many tasks and no value holds more than a
    line. A line's number is its place in its split (rows of a split have consecutive ids) plus the
    lines of the file's splits before it, which is a running sum over one row per split.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_id"), F.regexp_replace("value", "\r$", "").alias("value"))
    splits = lines.groupBy("file", "_at").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("file").alias("_f"), F.col("_at").alias("_a"), "_first",
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = lines.join(splits, (F.col("file") == F.col("_f")) & (F.col("_at") == F.col("_a")), "inner")
    return numbered.select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "value")


def split_lines(df: DataFrame, file_col: str, text: str, sep: str = "\r?\n") -> DataFrame:
    """(file, text) -> (file, line_no, value) with 1-based line numbers per file
    (``sep`` is a regular expression; the whole text is split, never a prefix)."""
    return df.select(file_col, F.posexplode(F.split(F.col(text), sep)).alias("line_no", "value")).withColumn(
        "line_no", F.col("line_no") + 1)


def read_delimited(spark: SparkSession, path: str, sep: str = ";@", columns: Sequence[str] | None = None,
                   fill: dict | float | None = 0, schema: StructType | str | None = None) -> DataFrame:
    """SR8: delimited text with a multi-character separator, fixed header list,
    nulls filled with 0 (numeric columns). With ``schema`` the files are read
    once; without, types are inferred by a second read."""
    reader = spark.read.option("sep", sep).option("header", columns is None and schema is None)
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", "true").csv(path)
    if columns:
        df = df.toDF(*columns)
    if fill is not None:
        df = df.fillna(fill)
    return df


def read_features(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """SR9: XML features; ``row_tag`` is the local element name (namespaces ignored).
    With ``schema`` the files are read once; without, it is inferred by a second read."""
    reader = (spark.read.format("xml").option("rowTag", row_tag.split(":")[-1]).option("ignoreNamespace", "true"))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def rename_columns(df: DataFrame, names: Sequence[str] | None = None, prefix: str | None = None) -> DataFrame:
    """PJ16: put a fixed header or a fixed name prefix."""
    if names:
        df = df.toDF(*names)
    if prefix:
        df = df.toDF(*[f"{prefix}{c}" for c in df.columns])
    return df


def read_with_outcome(spark: SparkSession, path: str, schema: StructType):
    """SK9 with the read: JSON-lines files parsed record by record (``from_json``,
    PERMISSIVE), returning ``(rows, outcome)``: the well-formed rows (with
    ``file_name``) and one outcome row per file (``file_name, status, n_rows,
    n_errors``), status ``processed`` or ``error``, ready to append to an audit
    table. Lines are parsed from text, so malformed records are counted, never
    silently dropped, and any query on the results is allowed."""
    full = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    lines = (spark.read.text(path).withColumn("file_name", F.input_file_name())
                  .filter(F.trim("value") != ""))
    parsed = lines.select("file_name", F.from_json("value", full, opts).alias("_r"))
    bad = F.col("_r._corrupt_record").isNotNull() | F.col("_r").isNull()
    outcome = (parsed.groupBy("file_name")
                     .agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(bad, 1)).alias("n_errors"))
                     .withColumn("status", F.when(F.col("n_errors") > 0, F.lit("error")).otherwise(F.lit("processed")))
                     .select("file_name", "status", "n_rows", "n_errors"))
    rows = parsed.filter(~bad).select(*[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields], "file_name")
    return rows, outcome
