import pytest
from churnlens import fixtures, schemas
from churnlens.operators import features, gold, quality
from churnlens.operators.joins import SkewPolicy
from churnlens.session import new_work_path
from pyspark.sql import functions as F

TINY = SkewPolicy(rows_per_task=20, pairs_per_task=200)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def tables(spark, data_dir):
    t = fixtures.load_tables(spark, data_dir)
    stored = {}
    for n in schemas.SOURCES:
        path = new_work_path(spark, n)
        getattr(t, n).write.parquet(path)
        stored[n] = spark.read.parquet(path)
    return fixtures.Tables(**stored)


def full_chain(t):
    out = gold.join_customer_closed(t.customer, t.closed)
    out = gold.join_transactions(gold.join_metrics(gold.join_accounts(out, t.account), t.metrics), t.transactions)
    return out.na.drop(subset=["total_relationship_count"]).na.fill({"status": schemas.OPEN_STATUS})


def test_gold_is_the_full_outer_chain(tables):
    built = gold.build_gold(tables)
    assert built.columns == schemas.GOLD_COLUMNS and len(built.columns) == 21
    assert built.count() == 4634
    assert same(built, full_chain(tables))


def test_salting_changes_no_row(tables):
    assert same(gold.build_gold(tables), gold.build_gold(tables, policy=TINY))


def test_drop_mode_loses_only_null_transactions(tables):
    match, drop = gold.build_gold(tables), gold.build_gold(tables, "drop")
    without = match.where("account_id is null and transaction_id is not null")
    lost = match.count() - drop.count()
    customers = without.select("customer_id").distinct().count()
    assert lost == without.count() - customers
    assert drop.where("account_id is null and transaction_id is not null").isEmpty()


def test_unknown_mode(tables):
    with pytest.raises(ValueError):
        gold.build_gold(tables, "keep")


def test_customers_come_from_metrics(tables):
    known = tables.metrics.where("total_relationship_count is not null").select("customer_id")
    assert gold.build_gold(tables).join(known, "customer_id", "left_anti").isEmpty()


def test_weights_count_the_joined_rows(tables):
    w, g = gold.gold_weighted(tables), gold.build_gold(tables)
    counted = g.groupBy("customer_id", "account_id").agg(
        F.count("*").alias("gold_rows"), F.count("transaction_date").alias("n_transaction_date")
    )
    assert same(counted, w)
    assert same(quality.gold_null_counts(w), quality.null_counts(g))


def test_plan_of_the_account_grain(tables, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gold.gold_accounts(tables))
        # One shuffle per source table: the joins share the partitioning on customer_id.
        initial = text.split("== Initial Plan ==")[-1]
        assert initial.count("Exchange hashpartitioning") == 4
        assert initial.count("SortMergeJoin") == 3 and "FullOuter" not in initial
        assert "IsNotNull(total_relationship_count)" in initial
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_plan_reads_only_what_it_needs(tables):
    text = plan(gold.gold_weighted(tables).agg(F.sum("gold_rows")))
    assert "CartesianProduct" not in text and "income" not in text
    # The weights need the transactions' key alone.
    assert "ReadSchema: struct<account_id:string>" in text


def test_first_row_plan_limits_before_the_shuffle(tables):
    text = plan(features.first_row_per_customer(gold.build_gold(tables)))
    assert "WindowGroupLimit" in text and "Partial" in text
