"""Scans and sinks. JSON and CSV schemas are always given; a malformed line fails the job."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rubrica import schemas


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One object per line; the codec follows from the file name (``.gz``, ``.bz2``, ``.zst``)."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("encoding", "UTF-8").json(path)


def write_jsonl(df: DataFrame, path: str, order_by: str | None = None, compression: str | None = None) -> None:
    """Text stays UTF-8 and NULL fields are written. ``order_by`` keeps input order over the part files."""
    rows = df.orderBy(order_by) if order_by else df
    writer = rows.write.mode("errorifexists").option("ignoreNullFields", False)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, record, text): the records of CSV files whose quoted fields may span lines, read by byte ranges.

    Lines are read range by range, so one large file is read by many tasks. A line starts inside a quoted field if the
    quotes before it in its file are odd in number: those of its range are counted in the range, those of the ranges before
    it are a running sum over one row per range. The same way lines that start a record are numbered, and a record's lines
    meet by its number. ``record`` counts from 1 in each file; blank lines between records are left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"),
    )
    inside = Window.partitionBy("file", "range").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)

    def before(rows: DataFrame, count: Column, name: str) -> DataFrame:
        """Add the sum of ``count`` over all earlier lines of the file."""
        counted = rows.withColumn("_count", count).withColumn("_local", F.coalesce(F.sum("_count").over(inside), F.lit(0)))
        totals = counted.groupBy("file", "range").agg(F.sum("_count").alias("_total"))
        totals = totals.select("file", "range", F.coalesce(F.sum("_total").over(ranges), F.lit(0)).alias("_offset"))
        return counted.join(totals, ["file", "range"]).withColumn(name, F.col("_local") + F.col("_offset")).drop("_count", "_local", "_offset")

    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    starts = (F.col("quotes") % 2 == 0).cast("long")
    numbered = before(before(lines, quotes, "quotes"), starts, "started")
    parts = F.array_sort(F.collect_list(F.struct("range", "line", "value")))
    text = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    records = numbered.groupBy("file", (F.col("started") + starts).alias("record")).agg(F.regexp_replace(text, r"\r\z", "").alias("text"))
    return records.where("text <> ''")


def read_split_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = False) -> DataFrame:
    """``schema`` columns and ``file`` of CSV files of any size (``csv_records``). A header must be the schema's names."""
    records = csv_records(spark, path)
    options = {"escape": '"', "mode": "FAILFAST"}
    ddl = lambda fields: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if header:
        names = F.from_csv("text", ddl([T.StructField(n, T.StringType()) for n in schema.names]), options)
        same = F.array([names[n] for n in schema.names]) == F.array([F.lit(n) for n in schema.names])
        # blank lines are no records, so the header is the first number left; assert_true is NULL where it holds
        heads = records.groupBy("file").agg(F.min("record").alias("_head"))
        records = records.join(heads, "file")
        records = records.where((F.col("record") > F.col("_head")) | F.assert_true(same, F.lit("the header differs from the schema")).isNotNull())
    parsed = records.select("file", F.from_csv("text", ddl(schema.fields), options).alias("row"))
    return parsed.select("row.*", "file")


def read_mcq_csv(spark: SparkSession, path: str | list[str], split: bool = False) -> DataFrame:
    """Headerless multiple-choice files ``<subject>_<split>.csv``, quoted fields may span lines.

    Files are read whole per task because records may hold line breaks, or by ranges with ``split`` (``read_split_csv``).
    """
    if split:
        raw, file_path = read_split_csv(spark, path, schemas.MCQ_FILE), F.col("file")
    else:
        options = {"multiLine": True, "escape": '"', "mode": "FAILFAST"}
        raw, file_path = spark.read.schema(schemas.MCQ_FILE).options(**options).csv(path), F.col("_metadata.file_path")
    name = F.regexp_extract(F.url_decode(file_path), r"([^/]+)\.csv(?:/[^/]*)?\z", 1)
    return raw.select(
        F.regexp_extract(name, r"\A(.*)_[^_]*\z", 1).alias("subject"),
        F.regexp_extract(name, r"_([^_]*)\z", 1).alias("split"),
        "question",
        F.array("a", "b", "c", "d").alias("options"),
        F.regexp_replace("answer", r"\r\z", "").alias("answer"),
    )


def read_safety_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.SAFETY_PROMPTS, split: bool = False
) -> DataFrame:
    """CSV with a header line; a header that differs from the schema fails. ``split`` reads by ranges (``read_split_csv``)."""
    if split:
        return read_split_csv(spark, path, schema, header=True).drop("file")
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_template(spark: SparkSession, path: str) -> str:
    """A prompt template file as one string (a few kilobytes, needed on the driver to build the plan)."""
    return spark.read.text(path, wholetext=True).first()["value"]


def read_lines(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Distinct non-empty lines of a list file."""
    lines = spark.read.text(path).select(F.trim("value").alias(name))
    return lines.where(F.col(name) != "").distinct()


def concat_sources(*tables: DataFrame, provenance: list[str] | None = None) -> DataFrame:
    """Rows of unlike sources under one schema, optionally labelled by source."""
    if provenance:
        tables = tuple(t.withColumn("source_name", F.lit(p)) for t, p in zip(tables, provenance, strict=True))
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


