"""Costly work on rows: dealt over tasks however few row groups a file has, and done once for a row."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from meridian.functions import catalog as fn

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", ["cmip6_headers", "cmip7_headers", "observation_headers", "unit_texts", "branch_times", "branch_times_of_two_units"])
def test_rows_are_dealt_out(spark, name):
    assert __spark_entry__.queries()[name](spark, SF).rdd.getNumPartitions() > 1


def test_units_are_split_once(spark):
    assert str(fn.canonical_units(F.col("u"))).lower().count("split") == 1
