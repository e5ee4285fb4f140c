"""Physical-plan properties the operators are designed for."""
from intake_spark.plans.registry import QUERIES

from conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ignore_filter_has_no_nested_loop(spark):
    p = plan(QUERIES["ignore_filter"](spark, SF["0.001"]))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "LeftAnti" in p


def test_include_joins_on_the_watch(spark):
    p = plan(QUERIES["include_match"](spark, SF["0.001"]))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "RLIKE" in p.upper() or "regexp" in p.lower()


def test_flagship_prunes_columns_and_stays_in_jvm(spark):
    p = plan(QUERIES["stable_candidates"](spark, SF["0.001"]))
    assert "props" not in p and "event_id" not in p
    assert "EvalPython" not in p and "ArrowEvalPython" not in p


def test_job_spec_reads_one_column(spark):
    p = plan(QUERIES["job_spec"](spark, SF["0.001"]))
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_prefix_join_is_equi(spark):
    p = plan(QUERIES["prefix_match"](spark, SF["0.001"]))
    assert "NestedLoopJoin" not in p


def test_no_query_uses_a_nested_loop_or_python_eval(spark):
    import re
    for key, q in QUERIES.items():
        if key.startswith("stream_"):
            continue
        p = plan(q(spark, SF["0.001"]))
        assert not re.search("NestedLoopJoin|CartesianProduct|BatchEvalPython", p), key


def test_hot_group_steps_combine_map_side(spark):
    """First-per-key, last-wins, arg-max and roll-ups aggregate partially before the shuffle."""
    for key in ("unprocessed", "last_wins_listing", "best_artifact", "dir_size_rollup", "delivery_manifest"):
        p = plan(QUERIES[key](spark, SF["0.001"]))
        assert "partial_" in p, key
