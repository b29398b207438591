"""Staged tables and size-checked broadcasts."""

import pytest

from clonewell.session import local_spark, small, stage, table, unstage


def test_staged_rows_stay_and_go(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    kept = stage(df)
    assert kept.schema == df.schema and sorted(map(tuple, kept.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    unstage(kept)
    with pytest.raises(Exception):
        kept.collect()
    unstage(df)
    assert stage(df.limit(0)).collect() == []
    df.write.parquet(str(tmp_path / "t.parquet"))
    assert table(spark, str(tmp_path), "t").count() == 2


def test_only_small_sides_are_hinted(spark):
    df = spark.range(50)
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(small(df, 50)) and not hinted(small(df, 49))


def test_one_session(spark):
    assert local_spark(4).sparkContext is spark.sparkContext
