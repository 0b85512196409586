import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("rubrica-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to a list of values and return the results in order."""

    def apply(function, values, schema="string"):
        from pyspark.sql import functions as F

        arity = len(values[0]) if isinstance(values[0], tuple) else 1
        rows = [(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]
        types = schema if isinstance(schema, (list, tuple)) else [schema] * arity
        names = [f"c{i}" for i in range(arity)]
        df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))
        result = function(*[F.col(n) for n in names])
        return [r["r"] for r in df.select("i", result.alias("r")).orderBy("i").collect()]

    return apply
