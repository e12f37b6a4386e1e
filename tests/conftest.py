import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hirelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores=8, partitions=4, checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate one text expression on a list of values."""
    from pyspark.sql import functions as F

    def run(values, expression):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
        found = rows.select("i", expression(F.col("t")).alias("v")).collect()
        return [r.v for r in sorted(found, key=lambda r: r.i)]

    return run
