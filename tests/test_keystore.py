import re

from headway.operators.keys import unseen
from headway.sources.keystore import KeyStore
from headway.sources.warehouse import Warehouse


def test_new_rows_are_found_without_moving_the_stored_keys(spark, rows, tmp_path):
    store = KeyStore(Warehouse(spark, str(tmp_path)), "fact_ride", buckets=4)
    store.add(spark.range(5000).selectExpr("concat('r', id) AS ride_id"))
    new = spark.range(4900, 5100).selectExpr("concat('r', id) AS ride_id").withColumn("more", rows_more())
    found = unseen(new, store.table(), "ride_id")
    # A broadcast would hide what a store of real size does.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = unseen(new, store.table(), "ride_id")
        assert found.count() == 100
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def rows_more():
    from pyspark.sql import functions as F

    return F.lit("x")


def test_a_store_that_fell_behind_is_made_anew(spark, core, rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    ride = lambda i: dict(ride_id=f"r{i}", start_date_sk=20240101)
    warehouse.append(core("fact_ride", *[ride(i) for i in range(3)]), "fact_ride")
    store = KeyStore(warehouse, "fact_ride", buckets=2)
    assert not store.check() and rows(store.table()) == [("r0",), ("r1",), ("r2",)]
    assert store.check()
    # The rows of a load came through, their keys did not.
    warehouse.append(core("fact_ride", ride(3)), "fact_ride")
    assert not KeyStore(warehouse, "fact_ride", buckets=2).check()
    assert rows(store.table(), "ride_id") == [("r0",), ("r1",), ("r2",), ("r3",)]
