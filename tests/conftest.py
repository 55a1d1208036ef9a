import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of an expression over rows of string arguments."""

    def run(build, *rows):
        from pyspark.sql import functions as F

        width = len(rows[0])
        schema = "n int, " + ", ".join(f"a{i} string" for i in range(width))
        df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], schema)
        out = df.select("n", build(*[F.col(f"a{i}") for i in range(width)]).alias("v")).orderBy("n").collect()
        return [r["v"] for r in out]

    return run
