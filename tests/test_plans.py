"""Plan properties that the scale design relies on (broadcast off, as at size)."""

import re

import pytest

import __spark_entry__ as E
from strata.plans import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _final_plan(df) -> str:
    physical = df._jdf.queryExecution().executedPlan()
    physical.execute().count()
    plan = physical.toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


def _exchanges(plan: str) -> list[str]:
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition)",
                                                          plan)]


def test_reconcile_report_two_key_exchanges(no_broadcast):
    ex = _exchanges(_final_plan(E.queries()["reconcile_report"](no_broadcast, SF)))
    assert sorted(ex) == ["SinglePartition", "hashpartitioning(order_id, 8)", "hashpartitioning(order_id, 8)"]


@pytest.mark.parametrize("name", ["scd2_history", "lifecycle_violations", "sessions"])
def test_sequence_queries_shuffle_events_on_key_and_bucket(no_broadcast, name):
    ex = _exchanges(_final_plan(E.queries()[name](no_broadcast, SF)))
    assert "hashpartitioning(user_id, _seq_bucket, 8)" in ex
    # the only exchange on the key alone is the per-key window over the bucket summary
    assert ex.count("hashpartitioning(user_id, 8)") <= 1


def test_discrepancies_scan_lineitem_once(no_broadcast):
    plan = _final_plan(E.queries()["discrepancies"](no_broadcast, SF))
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem\.parquet", plan)) == 1


def test_pruning_and_filters_reach_the_scan(no_broadcast):
    plan = _final_plan(E.queries()["missing_shipments"](no_broadcast, SF))
    orders_scan = re.search(r"FileScan parquet [^\n]*orders\.parquet[^\n]*", plan).group(0)
    assert "ReadSchema: struct<o_orderkey:bigint>" in orders_scan
    plan = _final_plan(E.queries()["purchase_events_vs_orders"](no_broadcast, SF))
    assert re.search(r"FileScan parquet [^\n]*events\.parquet[^\n]*PushedFilters: \[[^\]]*EqualTo\(event_type,purchase\)", plan)


def test_no_python_udfs_anywhere(spark):
    walks = ("flatten_struct", "flatten_ragged", "normalize_metadata", "single_objects", "object_records")
    for name, fn in QUERIES.items():
        if name.startswith("stream_") or name == "silver_folder":
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(n in plan for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "InPandas")), name
        # The walk over nested records is the one step outside the JVM.
        assert ("MapInArrow" in plan) == (name in walks), name


def test_constraint_checks_scan_each_table_once(no_broadcast):
    plan = _final_plan(E.queries()["constraint_checks"](no_broadcast, SF))
    for table in ("orders", "lineitem", "customer"):
        assert len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", plan)) == 1, table


def test_referential_checks_scan_lineitem_once(no_broadcast):
    plan = _final_plan(E.queries()["referential_checks"](no_broadcast, SF))
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem\.parquet", plan)) == 1


@pytest.mark.parametrize("name", ["validate_valid", "validate_errors", "json_parse"])
def test_each_record_is_parsed_once(spark, name):
    """The evaluate-once barrier keeps predicate pushdown from copying the
    JSON parse into every check (this cost 15x in validation before)."""
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    parses = plan.count("parseJson") + plan.count("from_json(")
    assert parses == 1, parses


def test_top_k_ranks_in_salted_stages(no_broadcast):
    ex = _exchanges(_final_plan(E.queries()["product_activity_window"](no_broadcast, SF)))
    assert "hashpartitioning(window_start, _salt, 8)" in ex   # first stage: per window and salt
    assert "hashpartitioning(window_start, 8)" in ex          # second stage: the few candidates


def test_reconcile_gold_outputs_derive_from_one_scan(no_broadcast):
    plan = _final_plan(E.queries()["discrepancy_counts"](no_broadcast, SF))
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem\.parquet", plan)) == 1


def test_broadcasts_are_left_to_the_threshold(no_broadcast):
    """With the threshold off nothing is broadcast, whatever its size."""
    plan = _final_plan(E.queries()["flatten_struct"](no_broadcast, SF))
    assert "BroadcastExchange" not in plan
    assert "hashpartitioning(o_custkey, 8)" in _exchanges(plan)


def test_activity_shuffles_events_once(no_broadcast):
    ex = _exchanges(_final_plan(E.queries()["product_activity_window"](no_broadcast, SF)))
    assert ex.count("hashpartitioning(product_id, _user_salt, 8)") == 1 and len(ex) == 3


def test_dedup_sorts_once(no_broadcast):
    plan = _final_plan(E.queries()["dedup_events"](no_broadcast, SF))
    assert len(re.findall(r"\bSort \[", plan)) == 1


@pytest.mark.parametrize("name", ["product_activity_window", "stream_product_activity_window"])
def test_activity_is_dealt_over_all_partitions(spark, name):
    """Rows expand after the shuffle, so partitions are not merged by their size in it."""
    plan = _final_plan(E.queries()[name](spark, SF))
    for keys in ("product_id, _user_salt", "window_start, _salt"):
        found = re.findall(rf"( *[+:-]*) ?(\S.*)\n[^\n]*ShuffleQueryStage[^\n]*\n[^\n]*Exchange hashpartitioning\({keys}, 8\)",
                           re.sub(r"#\d+L?", "", plan))
        assert found and not any("AQEShuffleRead coalesced" in line for _, line in found)
