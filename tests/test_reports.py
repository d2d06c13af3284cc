from helpers import values
from pyspark.sql import functions as F

from demandloom.operators import reports


def test_row_index_runs_over_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7).where("id % 3 > 0 and id > 200")
    found = reports.with_row_index(df, "at")
    assert [r["at"] for r in found.orderBy("id").collect()] == list(range(df.count()))
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
    assert reports.with_row_index(df.where("id < 0"), "at").count() == 0


def test_ordered_diff_finds_swapped_rows(spark):
    rows = [(i, str(i)) for i in range(50)]
    swapped = rows[:10] + [rows[11], rows[10]] + rows[12:]
    left = spark.createDataFrame(rows, "a int, b string").coalesce(3)
    right = spark.createDataFrame(swapped, "a int, b string").repartition(1)
    ordered = spark.createDataFrame([(k, *r) for k, r in enumerate(swapped)], "k int, a int, b string")
    right = ordered.repartitionByRange(4, "k").sortWithinPartitions("k").drop("k")
    assert values(reports.table_diff(left, right)) == []
    found = values(reports.ordered_diff(left, right), "side", "a", reports.POSITION)
    assert found == [("left", 10, 10), ("left", 11, 11), ("right", 10, 11), ("right", 11, 10)]
    assert values(reports.ordered_diff(left, left)) == []


def test_ordered_diff_of_frames_of_two_lengths(spark):
    left = spark.range(5).coalesce(1)
    found = reports.ordered_diff(left, left.where("id < 4"))
    assert values(found) == [("left", 4, 4)]


def test_head_keeps_the_first_rows_of_each_task(spark):
    df = spark.range(0, 1000, numPartitions=5).withColumn("v", F.col("id") * 7 % 1000)
    found = reports.head(df, 3, F.desc("v"))
    assert [r["v"] for r in found.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in found._jdf.queryExecution().executedPlan().toString()
