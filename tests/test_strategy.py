from pyspark.sql import functions as F

from tidewater.plans.strategy import broadcast_if_few


def _join_plan(spark, small):
    big = spark.range(0, 20000).withColumn("k", F.col("id") % 1000)
    joined = big.join(small, "k")
    return joined._jdf.queryExecution().executedPlan().toString(), joined


def test_counted_side_is_broadcast_only_under_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = spark.range(0, 50).withColumnRenamed("id", "k").where(F.col("k") % 2 == 0)
        plan, joined = _join_plan(spark, broadcast_if_few(side, max_rows=25))
        assert "BroadcastHashJoin" in plan
        assert joined.count() == 20 * 25
        plan, joined = _join_plan(spark, broadcast_if_few(side, max_rows=24))
        assert "BroadcastHashJoin" not in plan
        assert joined.count() == 20 * 25
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
