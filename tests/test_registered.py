"""A part of the registered queries against their SQL; ``python -m checks.compare`` runs all."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences, oracle_connection
from tests.conftest import FOLDER

SOME = (
    "clean_listings", "engineer_listings", "column_profile", "describe_numeric", "categorical_profile",
    "missing_report", "distinct_before_after", "outlier_summary", "price_stats", "histogram_by_group",
    "median_pivot", "hierarchy_counts", "segment_ratios", "share_within_group", "fit_preprocessor",
    "classification_report", "compare_models", "comparables_stats", "validate_configuration",
)


@pytest.fixture(scope="module")
def connection():
    pytest.importorskip("duckdb")
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_sql(spark, connection, name):
    assert not differences(spark, connection, FOLDER, entry.queries()[name], entry.oracle_sql()[name])


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 2
