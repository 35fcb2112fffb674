import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("churnlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="churnlake-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cells(spark):
    """Apply a standardizer to a list of strings."""

    def apply(parse, values):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(
            [(n, value) for n, value in enumerate(values)], "n int, cell string"
        )
        rows = df.select("n", parse(F.col("cell")).alias("out")).orderBy("n").collect()
        return [row.out for row in rows]

    return apply
