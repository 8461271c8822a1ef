"""Views over the sample tables: plans that hold on large tables."""

import datetime as dt

import pytest

from ledgermart.registry.features import full_store
from ledgermart.registry.health import sections
from ledgermart.sources.sample_tables import SampleTables


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.date(1997, 3, 14)
    rows = {
        "orders": ([(1, 7, 100.0, day), (2, 8, 50.0, day), (3, None, 10.0, day)],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date"),
        "lineitem": ([(1, 1, 3.0, "R", 0.1), (1, 2, 4.0, "N", 0.2), (2, 1, 5.0, "A", 0.0), (3, 1, 6.0, "N", 0.0), (None, 1, 1.0, "N", 0.0)],
                     "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string, l_discount double"),
        "customer": ([(7, 10.5, "BUILDING"), (9, 3.0, "MACHINERY")], "c_custkey long, c_acctbal double, c_mktsegment string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return SampleTables(spark, str(tmp_path))


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("view", ["clickstream", "loans", "financials"])
def test_views_send_no_table_through_the_driver(tables, view):
    assert "Broadcast" not in first_plan(getattr(tables, view))


def test_the_backfill_sends_no_table_through_the_driver(tables):
    assert "Broadcast" not in first_plan(full_store(tables))


def test_views_keep_their_rows(tables):
    clicks = {r["Customer_ID"]: (r["fe_1"], r["fe_2"]) for r in tables.clickstream.collect()}
    assert clicks == {"7": (7.0, 2), "8": (5.0, 1), None: (6.0, 1)}
    assert sorted((r["loan_id"], r["installment_num"]) for r in tables.loans.collect()) == [("1", 1), ("1", 2), ("2", 1), ("3", 1)]
    assert sorted((r["Customer_ID"], r["Num_of_Loan"]) for r in tables.financials.collect()) == [("7", "1"), ("9", "0"), ("9", "0")]


def test_sections_compute_each_component_once(tables):
    found = sections(tables)
    assert "FileScan" not in first_plan(found)  # both uses of a component read its checkpoint
    components = found.groupBy("section").count().collect()
    assert len(components) == 4 and len({r["count"] for r in components}) == 1  # every run has every section
