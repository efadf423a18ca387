"""Physical-plan properties the operators are designed to have."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokenize_not_pushed_into_scan_and_scan_pruned(spark):
    plan = _plan(E.queries()["doc_term_matrix"](spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "regexp_extract_all" not in scan  # the costly expression stays after the spread
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in scan  # column pruning


def test_top_k_per_group_is_limited_before_shuffle(spark):
    plan = _plan(E.queries()["kth_frequent_word"](spark, SF))
    assert "WindowGroupLimit" in plan


def test_lexicon_is_broadcast(spark):
    plan = _plan(E.queries()["lexicon_sentiment"](spark, SF))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["days_ago_filter"](spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "GreaterThanOrEqual(o_orderdate" in scan and "LessThan(o_orderdate" in scan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp" in scan


def test_tfidf_splits_hot_terms(spark):
    from quarry.operators import matrix as M

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    saved = M.IDF_BROADCAST_ROWS
    M.IDF_BROADCAST_ROWS = 10  # vocabulary "too large": take the split path
    try:
        df = E.queries()["tf_idf"](spark, SF)
        df.collect()
        plan = _plan(df)
    finally:
        M.IDF_BROADCAST_ROWS = saved
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftSemi" in plan and "LeftAnti" in plan  # hot terms map-side, the rest shuffled
    assert "SortMergeJoin" in plan


def test_segment_ids_without_whole_group_window(spark):
    plan = _plan(E.queries()["segment_by_header"](spark, SF))
    # every window is partitioned by (conversation, bucket) or runs over per-bucket rows
    assert "Window" in plan and "FLOOR" in plan.upper()


def _shuffles(df):
    df.collect()
    return _plan(df).split("+- == Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_shuffle_counts(spark):
    """Joined and aggregated once, not joined back."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        most = {"segment_by_header": 5, "pairwise_cosine": 8, "enrich_missing": 5, "usable_documents": 3, "score_by_year": 3, "balance_classes": 3}
        for name, n in most.items():
            assert _shuffles(E.queries()[name](spark, SF)) <= n, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
