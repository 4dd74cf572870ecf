from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession

from firstpour import BronzeConfig, LakeDatabase, storage
from firstpour.plans.load import prepare
from firstpour.session import tuned

SF = "/root/testdata/sf0.001"
DAY_1 = datetime(2024, 1, 15, 10, tzinfo=timezone.utc)
DAY_1_LATER = datetime(2024, 1, 15, 18, tzinfo=timezone.utc)
DAY_2 = datetime(2024, 1, 16, 10, tzinfo=timezone.utc)
DAY_3 = datetime(2024, 1, 17, 10, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8,3]").config("spark.ui.enabled", "false")
    session = tuned(builder).config("spark.sql.shuffle.partitions", "4").getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def root(spark):
    return storage.scratch(spark, "test")


@pytest.fixture
def config(spark, root):
    """A bronze layer of its own, whose source database ``LAKE`` is a folder of the test."""
    made = BronzeConfig(
        environment="TEST",
        root=f"{root}/bronze",
        databases={
            "LAKE": LakeDatabase(f"{root}/source/{{object}}"),
            "TPCH": LakeDatabase(f"{SF}/{{object}}.parquet"),
        },
        database=root.rpartition("/")[2].replace("-", "_"),
        fold_grace=0.0,
    )
    prepare(spark, made)
    return made


@pytest.fixture
def put(spark, root):
    """Replace a source table's rows."""

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{root}/source/{name}")

    return write


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
