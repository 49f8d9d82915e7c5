import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from samples import SF001, labelled_points  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("lineitem", "events", "embeddings", "orders", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def csv_points(spark, tmp_path_factory):
    """``labelled_points()`` written as text lines and read back."""
    from fairsketch.sources.points import read_points

    path = tmp_path_factory.mktemp("points") / "points.csv"
    path.write_text("".join(f"{x},{y},{g}\n" for (x, y), g in labelled_points()))
    return read_points(spark, f"file:{path}", dims=2)
