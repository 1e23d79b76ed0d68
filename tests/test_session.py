import os

import pytest

from veilcorpus.session import discard, materialize


def test_written_tables_can_be_dropped(spark, tmp_path):
    table = materialize(spark.range(10).selectExpr("id", "'a' AS `file name`"))
    assert table.count() == 10
    folder = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    discard(table)
    assert not os.path.exists(folder)
    spark.range(3).write.parquet(f"{tmp_path}/own")
    with pytest.raises(ValueError):
        discard(spark.read.parquet(f"{tmp_path}/own"))
    assert spark.read.parquet(f"{tmp_path}/own").count() == 3
