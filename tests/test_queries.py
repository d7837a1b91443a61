"""Every registered query against its SQL on the smallest supplied data set."""

import importlib.util
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from headway.plans import queries
from headway.plans.oracle import ORACLE
from headway.plans.queries import REGISTRY
from headway.schemas import STAGING, WAREHOUSE
from headway.sources import supplied

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="supplied tables are not here")

_spec = importlib.util.spec_from_file_location("check", Path(__file__).parents[1] / "tools" / "check.py")
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(driver.queries())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(REGISTRY))
def test_same_rows_as_sql(spark, db, name):
    df = driver.queries()[name](spark, str(SF))
    result = db.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert check.as_rows(df.columns, df.collect()) == check.as_rows(columns, result.fetchall())


@pytest.mark.parametrize("name", list(supplied.SCHEMAS))
def test_declared_schemas_match_the_files(spark, name):
    inferred = spark.read.parquet(f"{SF}/{name}.parquet").schema
    declared = supplied.table(spark, str(SF), name).schema
    assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared]


@pytest.mark.parametrize("name", [n for n in REGISTRY if not n.startswith(("stream", "warehouse", "load", "rides_by_date"))])
def test_plans_avoid_cross_joins_and_single_task_windows(spark, name):
    plan = driver.queries()[name](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # Gathering into one task is left to global aggregates and to sums over book sizes.
    for block in plan.split("Exchange SinglePartition")[1:]:
        child = next(line for line in block.splitlines()[1:] if line.strip(" :|"))
        assert re.search(r"HashAggregate", child), child


def test_operators_yield_the_declared_types(spark):
    """Before the registered queries cast for the client libraries."""
    t = queries.Tables(spark, str(SF))
    for name, df in {**t.core(), **{f"stg.{n}": t.staged(n) for n in STAGING}}.items():
        declared = WAREHOUSE[name].types
        assert {f.name: f.dataType.simpleString() for f in df.schema} == declared, name
