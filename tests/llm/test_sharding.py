"""Types of the sharding query."""

from tallyspark.llm import queries


def test_slot_is_long(spark):
    assert dict(queries.op6_sharding(spark, "/root/testdata/sf0.001").dtypes)["slot"] == "bigint"
