import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """JSON texts -> a raw table."""
    from pyspark.sql import functions as F

    def make(*texts: str):
        df = spark.createDataFrame([(t,) for t in texts], "value string")
        return df.select(
            F.try_parse_json("value").alias("record_content"),
            F.lit("f.ndjson").alias("source_file"),
            F.lit("2025-01-01").cast("timestamp").alias("ingestion_time"),
        )

    return make
