from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("cellflux-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def utc(spark):
    """Each test starts in UTC, whatever zone the one before has set."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    yield connection
    connection.close()


@pytest.fixture
def line_file(tmp_path):
    """Write lines to a record file; returns its folder."""

    def write(lines, name="records.txt", folder="in"):
        target = tmp_path / folder
        target.mkdir(exist_ok=True)
        (target / name).write_text("".join(line + "\n" for line in lines), encoding="utf-8")
        return str(target)

    return write
