import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sparktidy-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Apply a column function to a list of Python values."""

    def run(rule, data, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
        return [r[0] for r in rows.select(rule(F.col("v")).alias("o"), "i").orderBy("i").collect()]

    return run
