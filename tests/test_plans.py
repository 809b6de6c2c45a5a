"""What the physical plans must look like for the queries to hold at scale."""

import pytest

from gleaner.plans import QUERIES
from gleaner.streaming import streams

FOLDER = "/root/testdata/sf0.001"
STREAMED = {
    "stale_run_sessions", "preview_stream", "stale_crawl_stream", "live_rollup", "live_missing_counts",
    "idempotent_items", "stop_after_drain", "write_items_stream", "time_limit_stream",
}


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED))
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # row-at-a-time Python
    assert "SinglePartition" not in text or name in {"debug_report", "missing_field_counts", "offsite_counts"}


@pytest.mark.parametrize("name", ["rule_cascade", "job_index_rows", "select_nodes", "best_element", "page_body_text", "auto_fields"])
def test_pages_are_parsed_once_and_not_shuffled_after(spark, name):
    text = plan(spark, name)
    assert text.count("MapInArrow") == 1
    assert "Exchange" not in text.split("MapInArrow")[0]


@pytest.mark.parametrize("name", ["host_links", "page_language", "extract_links", "extract_logos", "hidden_inputs"])
def test_flat_scans_stay_in_the_jvm(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "InArrow" not in text


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<url:string>" in plan(spark, "on_site").replace("page_id:bigint,", "")
    assert "l_comment" not in plan(spark, "line_rollup") and "l_extendedprice" not in plan(spark, "line_rollup")


@pytest.mark.parametrize("name", ["field_rollup", "latest_run", "drop_counts", "clean_url_feed", "run_lifecycle"])
def test_groups_are_reduced_before_the_shuffle(spark, name):
    below = plan(spark, name).split("Exchange hashpartitioning")[-1]
    assert "partial_" in below


@pytest.mark.parametrize("name", ["site_validity", "max_items_limit", "preview_cutoff"])
def test_first_rows_are_cut_before_the_shuffle(spark, name):
    below = plan(spark, name).split("Exchange hashpartitioning")[-1]
    assert "WindowGroupLimit" in below


def test_elements_do_not_carry_their_page(spark):
    generate = next(line for line in plan(spark, "explode_elements").splitlines() if "Generate" in line)
    assert "[page_id" in generate and "page_html#" not in generate.split("], false")[0].rsplit("[", 1)[-1]


def test_stream_names_exist():
    assert STREAMED <= set(QUERIES) and callable(streams.live_rollup)
