import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("the driver's tables are not here")
    return path


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


@pytest.fixture(scope="session")
def same_rows():
    """Whether two pandas frames hold the same rows, columns by name, order aside."""

    def rows(frame, columns):
        return sorted(tuple(str(v) for v in row) for row in frame[columns].itertuples(index=False, name=None))

    def same(a, b):
        columns = sorted(a.columns)
        assert columns == sorted(b.columns)
        assert rows(a, columns) == rows(b, columns)

    return same
