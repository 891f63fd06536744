"""Physical plan properties: no Python UDF anywhere, literal dimensions
broadcast, filters and column pruning reach the scan."""

import pytest

from healthmart.plans import checks as K
from tests.conftest import SF_SMALL

PLAN_KEYS = ["q1_source_totals", "q4_age_groups", "q12_wait_bucket_rate", "star_rollup", "elt_clean_no_show",
             "dedupe_keep_first", "membership_filter", "iqr_filter", "fill_median", "anti_join_orphans"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLAN_KEYS)
def test_no_python_udf(spark, key):
    text = plan_text(K.QUERIES[key](spark, SF_SMALL))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in text


def test_dims_broadcast_in_reports(spark):
    text = plan_text(K.QUERIES["star_rollup"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_pushdown_and_pruning(spark):
    df = K.QUERIES["membership_filter"](spark, SF_SMALL)
    text = plan_text(df)
    assert "PushedFilters: [IsNotNull(o_orderpriority), IsNotNull(o_orderstatus), In(o_orderpriority" in text \
        or "In(o_orderpriority" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in text


def test_keep_first_partial_aggregation(spark):
    text = plan_text(K.QUERIES["dedupe_keep_first"](spark, SF_SMALL))
    assert "partial_min" in text  # map-side combine before the shuffle
    assert "Window" not in text


def test_dense_ids_many_partitions(spark):
    df = K.QUERIES["dense_ids"](spark, SF_SMALL)
    assert df.rdd.getNumPartitions() > 1


@pytest.mark.parametrize("key", ["iqr_filter", "fill_median"])
def test_quantiles_without_a_buffer_of_all_values(spark, key):
    text = plan_text(K.QUERIES[key](spark, SF_SMALL))
    assert "ObjectHashAggregate" not in text and "percentile" not in text and "median(" not in text


@pytest.mark.parametrize("key", ["q1_source_totals", "minmax_scale", "max_scale", "fill_median", "iqr_filter",
                                 "elt_enriched_no_show"])
def test_building_a_plan_starts_no_job(spark, key):
    group = f"build-{key}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        K.QUERIES[key](spark, SF_SMALL)
        seen = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    # reading a Parquet schema is a job of one task; an aggregate has more stages
    assert all(len(spark.sparkContext.statusTracker().getJobInfo(j).stageIds) == 1 for j in seen)
