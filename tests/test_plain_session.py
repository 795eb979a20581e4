"""Registered queries in a session whose Arrow setting is Spark's own (off), as a session that we did not build."""

import pytest
import test_catalog
from test_catalog import con  # noqa: F401

import __spark_entry__ as entry

NAMES = ["ru9_fibre_rule_engine", "ru3_rule_errors", "ru13_execution_windows", "ml2_linear_prediction", "ag3_soft_tags", "ru5_sliding_avg_islands"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_without_arrow(spark, con, name):  # noqa: F811
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        test_catalog.check_query(con, name, entry.queries()[name](spark, test_catalog.SF))
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
