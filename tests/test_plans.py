"""What the plans must and must not hold, over the smallest tables."""

import pytest
from conftest import SMALL

from quirework.plans import data_problems, engine_queries

QUERIES = engine_queries.QUERIES | data_problems.QUERIES


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_of_tables(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name,has,lacks",
    [
        ("p1_found", ["PushedFilters: [IsNotNull(superseded_at)]"], ["Exchange", "payload", "Python", "Pandas"]),  # the journal alone
        ("p2_points", ["Generate inline"], ["Exchange", "Python", "Pandas"]),
        ("p2_profile_values", ["Generate inline"], ["Exchange", "Python", "Pandas"]),
        ("p4_found", ["LeftAnti"], ["execution_profile_json", "error_message"]),
        ("p3_found", [], ["Pandas", "Python"]),
        ("q01_status_counts", ["partial_count", "ReadSchema: struct<job_row_id:bigint,run_no:int,source_path:string,stage:string,status:string>"], []),
        ("q05_jobs_page", ["TakeOrderedAndProject"], []),
        ("q11_expected_vs_actual", ["ReadSchema: struct<source_path:string,page_no:bigint>"], ["page_json"]),
        ("q22_fold_state", ["collect_list"], ["Pandas", "Python"]),
        ("q30_content_identity", ["PushedFilters: [IsNotNull(text)]", "partial_count"], ["loaded_at"]),
        ("q28_containment", ["LeftSemi"], []),
    ],
)
def test_shape(spark, name, has, lacks):
    text = plan(spark, name)
    for part in has:
        assert part in text, part
    for part in lacks:
        assert part not in text, part


def test_sides_of_the_open_run_read_what_they_need(spark):
    from quirework.operators import incremental
    from quirework.session import read_table

    tables = read_table(spark, SMALL, "jobs"), read_table(spark, SMALL, "scan_runs")
    for side in (incremental.listed, incremental.finished):
        text = side(*tables)._jdf.queryExecution().executedPlan().toString()
        assert "partial_max" in text and "run_no" in text.partition("PushedFilters: ")[2].partition("\n")[0]
        assert "execution_profile_json" not in text and "error_message" not in text

