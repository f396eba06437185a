"""A key holding a third of the rows: the de-duplication shuffle stays small.

Measured, not inferred from the plan text: the shuffle's records-written
metric of the final plan.
"""

from pyspark.sql import functions as F

from indicata.operators.dedup import latest_per_key


def shuffle_records(df) -> int:
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    total, stack = 0, [plan.executedPlan() if "Adaptive" in plan.nodeName() else plan]
    while stack:
        node = stack.pop()
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
        keys = node.metrics().keys().mkString(",").split(",")
        if node.nodeName() == "Exchange" and "shuffleRecordsWritten" in keys:
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return total


def test_hot_key_is_reduced_before_the_shuffle(spark):
    n, parts = 30_000, 6
    df = spark.range(n, numPartitions=parts).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),  # key 0: a third
        F.col("id").alias("v"))
    out = latest_per_key(df, ("k",), ("v",))
    written = shuffle_records(out)
    other_keys = n - n // 3
    assert 0 < written <= other_keys + parts  # the hot key ships at most one row per map task
    assert out.filter(F.col("k") == 0).first().v == n - 3
    assert out.count() == other_keys + 1
