import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from harborline import build_session

    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Five documents of two instances; the fourth repeats the first's uri."""
    from pyspark.sql import functions as F
    from harborline.operators.envelope import envelope

    rows = spark.createDataFrame(
        [(i, "inst-1" if i < 4 else "inst-2", f"https://blog.example.com/post/{i % 3}", f"text {i}")
         for i in range(5)], "n long, inst string, uri string, body string")
    return envelope(rows, connector_id="rss", instance_id=F.col("inst"), uri=F.col("uri"),
                    content=F.col("body"), content_type="text/plain", seq=F.col("n"),
                    cursor_value=F.col("n"), tags=["t"])
