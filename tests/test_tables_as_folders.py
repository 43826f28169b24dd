"""Streams of tables that are folders of files."""

import pytest

from pressroom.plans.catalog import QUERIES


@pytest.mark.parametrize("name", ["stream_dedupe", "stream_register"])
def test_stream_of_a_folder_table(spark, small, tmp_path, name):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    pages.repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    got, want = (QUERIES[name](spark, sf).collect() for sf in (str(tmp_path), small))
    assert want and sorted(got, key=repr) == sorted(want, key=repr)
