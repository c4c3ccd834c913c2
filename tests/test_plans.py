"""How often and how wide rows move."""

import pytest
from pyspark.sql import functions as F

from foliary.operators import journal
from foliary.plans import catalog

SF = "/root/testdata/sf0.001"


def scans(df, table="lineitem"):
    return df._jdf.queryExecution().sparkPlan().toString().count(f"{table}.parquet")


@pytest.mark.parametrize("name, most", [("reading_status", 3), ("case_state", 3), ("rebalance", 0), ("type_certainty_counts", 1), ("stage_lists", 3)])
def test_scans(spark, name, most):
    """The lines are read once for the listing and once each time the journal is named (its shuffle is used again); what a rebalance moves follows from sums."""
    assert scans(catalog.QUERIES[name](spark, SF)) <= most


def test_cases_that_lose_all_records_of_an_id(spark):
    records = [("a", "A", True, None), ("b", "B", True, "a"), ("b", "C", True, None), ("c", "D", True, "a"), ("d", "E", False, None), (None, "F", True, "a"), (None, "G", True, None)]
    df = spark.createDataFrame(records, "id string, caso string, was_read boolean, copied_from string")
    bad = spark.createDataFrame([("a",), ("d",), ("a",)], "id string")
    kept = {tuple(r) for r in journal.cascade_invalidate(df, bad).collect()}
    assert kept == {("b", "C", True, None), ("d", "E", False, None), (None, "G", True, None)}
    assert {r["caso"] for r in journal.reopened_cases(df, bad).collect()} == {"A", "D", "F", "G"}
    assert scans(journal.reopened_cases(catalog.view(spark, SF, "journal").select("id", "caso", "was_read", F.lit(None).cast("string").alias("copied_from")), bad)) == 1


def test_steps_of_a_mix_end_in_tables(spark):
    """The driver holds no plan of all steps: the last one reads tables and has no windows of its own."""
    from foliary.llm import mixing

    docs = spark.createDataFrame([(i, "word " * (i % 40), f"s{i % 3}") for i in range(60)], "doc_id long, text string, source string")
    out = mixing.mix(docs)
    assert "Window" not in out._jdf.queryExecution().sparkPlan().toString()
    assert out.count() == 60 and out.agg(F.max("taken")).first()[0] > 0


@pytest.mark.parametrize("name", ["cascade_invalidate", "reopened_cases"])
def test_copies_move_by_what_they_were_made_from_and_records_do_not(spark, name):
    """Records carry numbers for their cases and contents, and only copies are dealt a second time."""
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(concat(cast(l_partkey" not in plan and "coalesce(copied_from" not in plan
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line and "copied_from#" in line]
    assert joins and plan.count("Doe,Roe") == (name == "reopened_cases")
