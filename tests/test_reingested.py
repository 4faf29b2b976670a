"""Results taken in again: of known executions alone, and dealt over tasks by their number."""

import datetime as dt

from pyspark.sql import functions as F

from meridian.plans import ledger


def test_results_of_unknown_executions_are_not_taken(spark):
    runs = spark.createDataFrame([(1, 7, "h", None, dt.datetime(2024, 1, 1)), (2, 7, "h", None, dt.datetime(2024, 1, 1))], "id long, group_id long, dataset_hash string, successful boolean, created_at timestamp_ntz")
    values = spark.createDataFrame([(1, True, 1.0), (1, True, 2.0), (2, True, 3.0), (2, False, 4.0), (3, True, 5.0)], "execution_id long, whole boolean, value double")
    every, taken = ledger.reingested(runs, values, F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"))
    made = every.join(runs.select("id"), "id", "left_anti").collect()
    assert [r.group_id for r in made] == [7] and sorted((r.execution_id, r.value) for r in taken.collect()) == [(made[0].id, 1.0), (made[0].id, 2.0)]


def test_results_are_dealt_over_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(ledger, "TASK_ROWS", 100, raising=False)
    runs = spark.range(3000).select("id", F.lit(1).alias("group_id"), F.lit(True).alias("successful"), F.lit(None).cast("timestamp_ntz").alias("created_at"))
    values = runs.select(F.col("id").alias("execution_id"), F.lit(True).alias("whole"))
    taken = ledger.reingested(runs, values, F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"))[1]
    assert taken.count() == 3000 and taken.rdd.getNumPartitions() == 30
