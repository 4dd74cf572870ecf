"""Tasks that fail and are run again, as after the loss of an executor."""

import pytest
from pyspark import TaskContext

from firstpour.operators.land import WriteOptions, land_full, land_incremental
from tests.conftest import DAY_1


def flaky(batches):
    """Fails every first attempt after it has handed over some rows."""
    for batch in batches:
        yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")


@pytest.mark.parametrize("land", [land_full, land_incremental])
@pytest.mark.parametrize("options", [WriteOptions(), WriteOptions(rebalance=True), WriteOptions(files=3)])
def test_rows_are_landed_and_counted_once(spark, config, land, options):
    rows = spark.range(0, 1000, 1, 4).mapInPandas(flaky, "id bigint")
    landed = land(rows, f"{config.root}/flaky", DAY_1, "id", options)
    assert (landed.rows, landed.high) == (1000, "999")
    read = spark.read.parquet(landed.path)
    assert (read.count(), read.select("id").distinct().count()) == (1000, 1000)
