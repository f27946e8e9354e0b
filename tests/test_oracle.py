"""Every catalog query against its DuckDB twin on the smallest driver tables.

The driver's own check runs the same comparison at sf0.01; ``tests/oracle_harness.py``
runs it at any scale from the command line.
"""

import pytest

import __spark_entry__ as entry
from carelens.plans import catalog
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
SQL = catalog.SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql_twin(spark, con, name):
    ok, n, _, _, msg = compare(spark, con, SF, name, catalog.QUERIES[name], SQL[name])
    assert ok, msg


def test_every_query_has_a_twin_or_is_rows_only():
    assert set(catalog.QUERIES) - set(SQL) == {"batch_scores", "candidate_comparison", "model_search"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["age_band", "los_bucket", "n_encounters", "readmission_rate",
                                             "mean_prior_utilization"]


TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


# streams run when the query is called; their columns are cast by the batch functions they share
@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("stream_")))
def test_query_types_match_sql_twin(spark, con, name):
    sdf = catalog.QUERIES[name](spark, SF)
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(SQL[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
