"""Round trips of driver tables through every file shape the engine reads and writes."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rubrica.operators.ordering import with_position
from rubrica.operators.scratch import scratch_path, written
from rubrica.operators.skew import spread
from rubrica.plans.registry import query, table
from rubrica.sources import files

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
DOCUMENT_SQL = "SELECT doc_id, text, lang, n_chars FROM documents"


def _round_trip(spark: SparkSession, sf_dir: str, compression: str | None) -> DataFrame:
    path = scratch_path(spark, "documents-jsonl")
    documents = spread(table(spark, sf_dir, "documents").select(DOCUMENT.names), "doc_id")
    files.write_jsonl(documents, path, compression=compression)
    return files.read_jsonl(spark, path, DOCUMENT)


@query("scan_jsonl", DOCUMENT_SQL)
def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, None)


@query("scan_jsonl_gz", DOCUMENT_SQL)
def scan_jsonl_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "gzip")


@query(
    "ordered_sink",
    "SELECT doc_id, key, row_number() OVER (ORDER BY key) - 1 AS position FROM (SELECT doc_id, md5(doc_id::VARCHAR) AS key FROM documents)",
)
def ordered_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the order of a key over all part files; the position is that of the line in the files."""
    path = scratch_path(spark, "ordered-jsonl")
    keyed = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("key"))
    files.write_jsonl(keyed, path, order_by="key")
    lines = files.read_jsonl(spark, path, keyed.schema)
    place = F.struct("_metadata.file_name", F.monotonically_increasing_id().alias("line"))
    return with_position(written(lines.select("*", place.alias("place")), "ordered-lines"), "place").select("doc_id", "key", "position")


def _write_csv(df: DataFrame, path: str, header: bool) -> None:
    (
        df.write.option("quoteAll", True)
        .option("escape", '"')
        .option("header", header)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


_MCQ_SQL = """
    SELECT '{name}' AS subject, '{split}' AS split, text || chr(10) || 'Pick "one".' AS question,
           'a,1;' || {key} || ';"c";d' AS options, substr('ABCD', ({key} % 4)::INTEGER + 1, 1) AS answer FROM {name}
"""


MCQ_SQL = " UNION ALL ".join(
    _MCQ_SQL.format(name=name, split=part, key=key) for name, part, key in (("benchmark", "dev", "item_id"), ("documents", "test", "doc_id"))
)


@query(
    "scan_mcq_csv",
    MCQ_SQL,
)
def scan_mcq_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mcq(spark, sf_dir, split=False)


@query("scan_mcq_csv_split", MCQ_SQL)
def scan_mcq_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by byte ranges, records put together from lines by the parity of their quotes."""
    return _mcq(spark, sf_dir, split=True)


def _mcq(spark: SparkSession, sf_dir: str, split: bool) -> DataFrame:
    folder = scratch_path(spark, "mcq")
    for name, part, key in (("benchmark", "dev", "item_id"), ("documents", "test", "doc_id")):
        letter = F.substring(F.lit("ABCD"), (F.col(key) % 4 + 1).cast("int"), F.lit(1))
        rows = table(spark, sf_dir, name).select(
            F.concat("text", F.lit('\nPick "one".')).alias("question"), F.lit("a,1").alias("a"),
            F.col(key).cast("string").alias("b"), F.lit('"c"').alias("c"), F.lit("d").alias("d"),
            F.concat(letter, F.when(F.col(key) % 2 == 0, "\r").otherwise("")).alias("answer"),
        )
        _write_csv(rows, f"{folder}/{name}_{part}.csv", header=False)
    return files.read_mcq_csv(spark, f"{folder}/*.csv", split).withColumn("options", F.array_join("options", ";"))


@query(
    "scan_csv_header",
    "SELECT doc_id::VARCHAR AS id, lang AS harm_area, n_chars::VARCHAR AS counter, source AS category, "
    "text AS prompts_final FROM documents",
)
def scan_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "safety-csv")
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("harm_area"),
        F.col("n_chars").cast("string").alias("counter"), F.col("source").alias("category"),
        F.col("text").alias("prompts_final"),
    )
    _write_csv(rows, path, header=True)
    return files.read_safety_csv(spark, path)
