"""Only the reader and writer options: a database is not started for tests."""

from headway.sources.jdbc import Database, Split

DB = Database("jdbc:example://host/db", "example.Driver", "me", "secret", {"stringtype": "unspecified"})


def test_unsplit_read():
    assert DB.read_options("stg.users") == {
        "url": "jdbc:example://host/db", "driver": "example.Driver", "user": "me", "password": "secret",
        "stringtype": "unspecified", "dbtable": "stg.users", "fetchsize": "10000"}


def test_split_read():
    options = DB.read_options("dwh.fact_ride", Split("start_date_sk", 20240101, 20250101, 64))
    assert {k: options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "start_date_sk", "lowerBound": "20240101", "upperBound": "20250101",
        "numPartitions": "64"}


def test_append():
    options = DB.write_options("mart", connections=8, createTableOptions="ORDER BY date")
    assert options["numPartitions"] == "8" and options["createTableOptions"] == "ORDER BY date"
    assert "numPartitions" not in DB.write_options("mart")


def test_password_is_not_shown():
    assert "secret" not in repr(DB)
    assert "user" not in Database("jdbc:x", "d").options()
