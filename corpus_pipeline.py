"""From raw documents to sampled token ids: the stages of one corpus pipeline, each an operator of rubrica.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last keep the columns of ``documents``. Null texts count as empty to the first four stages
and give a row of nulls in the last; repeated rows are one group of the near-duplicate stage; an empty table passes
through as an empty table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubrica.llm import decontam, fuzzylines, quality, sampling, simhash
from rubrica.llm.common import table, written
from rubrica.llm.queries import MODEL_PATH


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts short of lines that repeat an earlier line of the corpus, exactly or nearly."""
    return fuzzylines.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints of three-word shingles, linked at two or fewer differing bits."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage within its error budget."""
    marked = decontam.with_leaks(docs, table(spark, sf_dir, "benchmark"), "_leaks")
    return marked.where(F.size("_leaks") == 0).drop("_leaks")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each text, with the decoded text checked against it."""
    return sampling.encode_documents(docs, MODEL_PATH)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

#: A trained classifier and approximate candidates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
