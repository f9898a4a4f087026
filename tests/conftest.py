import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "tests",
        master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_driver_memory="6g",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluate an expression over a list of texts."""

    def run(make, values, type_name="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {type_name}")
        from pyspark.sql import functions as F

        return [r["y"] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
