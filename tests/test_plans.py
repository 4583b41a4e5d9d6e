"""Plan regressions: the scale properties of the registered queries."""

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
ROW_LEVEL = ["rule_score_a", "rule_score_b", "consensus", "fallback_gate", "select_features", "drop_ids",
             "binary_encode", "range_check", "fill_absent", "decode_flags", "vector_roundtrip", "assemble",
             "hash_split", "fold_assign", "linear_score", "threshold", "clamp", "model_comparison",
             "recommendation", "standardize", "features_zero_imputed", "verdict_text"]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    qe = df._jdf.queryExecution()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return qe.explainString(mode)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_no_cross_or_nested_loop_join(spark, sf_small, name):
    plan = physical(QUERIES[name](spark, sf_small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_row_level_queries_do_not_shuffle(spark, sf_small, name):
    assert "Exchange" not in physical(QUERIES[name](spark, sf_small))


def test_null_row_filter_reaches_scans_and_inner_join(spark, sf_small):
    text = formatted(QUERIES["drop_null_rows"](spark, sf_small))
    assert "LeftOuter" not in text and "Inner" in text
    assert "PushedFilters: [IsNotNull(quality), IsNotNull(toxic)" in text


def test_derived_views_read_only_the_key(spark, sf_small):
    text = formatted(QUERIES["consensus"](spark, sf_small))
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_imputation_is_one_aggregate_pass(spark, sf_small):
    import re
    text = formatted(QUERIES["zero_impute"](spark, sf_small))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 2   # rows + one aggregate
    assert len(re.findall(r"^Subquery:\d+", text, re.M)) == 1           # all means in one subquery
    assert "Join" not in text
