"""Costly inputs are read once for all that is made of them."""

from pyspark.sql import functions as F

from tests.test_library import results


def test_values_are_found_once_for_screening(spark):
    r, n = results(spark), spark.sparkContext.accumulator(0)

    def seen(x):
        n.add(1)
        return x

    own = r.values.where("type = 'scalar'").withColumn("value", F.udf(seen, "double")("value"))
    page = type(r)(own, r.executions, r.groups, r.diagnostics, dimensions=r.dimensions).scalar_values()
    assert page.total == 6 and len(page.rows.collect()) == 6 and page.facets.count() > 0
    assert n.value == 9
