import pytest


@pytest.fixture
def on_file(spark, tmp_path):
    """A frame written as Parquet and read back, as the operators that need file positions get it."""
    def write(rows, schema, files=1, name="t"):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, schema).repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return write
