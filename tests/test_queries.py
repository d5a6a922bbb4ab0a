"""Every registered query against its SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from holdfast.sources import file_inventory
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


NAMES = [name for name in entry.queries() if name != "pipeline" and not name.startswith("op")]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    df = entry.queries()[name](spark, FOLDER)
    if name in ORACLE:
        assert differences(df, connection, ORACLE[name]) == []
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())
    assert set(NAMES) <= set(ORACLE)


def test_comparison_sees_differences(spark, connection):
    df = entry.queries()["filter_in"](spark, FOLDER)
    good = ORACLE["filter_in"]
    assert differences(df, connection, good) == []
    assert differences(df, connection, good.replace("MACHINERY", "FURNITURE"))
    assert differences(df, connection, good + " LIMIT 3")
    assert differences(df, connection, good.replace("c_custkey,", "c_custkey AS k,"))
    assert differences(df.where("false"), connection, good + " LIMIT 0") == ["no rows"]


def test_entry_without_a_library_of_the_training_operators():
    """In a fresh interpreter that lacks it, all other queries are there."""
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(*sorted(e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parent.parent)
    assert said.stdout.split() == sorted(NAMES)


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "customer_id", "ticker", "account_type", "net_shares", "total_bought_value",
        "total_sold_value", "net_cash_impact",
    ]


def test_file_inventory_counts_files(spark, tmp_path):
    for name in ("original_schema", "new_schema"):
        spark.range(4, numPartitions=2).write.parquet(str(tmp_path / name))
    found = file_inventory(spark, str(tmp_path), {"new_schema": "%new_schema%"})
    groups = {row["schema_type"]: row for row in found.collect()}
    assert set(groups) == {"new_schema", None}
    assert all(row["total_bytes"] > 0 and row["num_of_files"] == 2 and row["num_of_folders"] == 1 for row in groups.values())
