import datetime as dt
from dataclasses import replace

import pytest
from churnlens import fixtures
from churnlens.fixtures import FIXTURE_DOMAINS
from churnlens.functions import scalars
from churnlens.operators import features, gold, joins
from churnlens.operators.joins import SkewPolicy
from churnlens.plans import registry
from pyspark.sql import functions as F


def test_one_hot_of_missing_is_all_zero(spark):
    df = spark.createDataFrame([("M",), (None,), ("F",)], "gender string")
    got = [tuple(r) for r in features.one_hot(df, {"gender": ["F", "M"]}).collect()]
    assert got == [(0, 1), (0, 0), (1, 0)]


def test_discovered_domains(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y")], "k string, l string")
    assert features.discover_domains(df, ["k", "l"]) == {"k": ["a", "b"], "l": ["x", "y"]}
    with pytest.raises(ValueError):
        features.discover_domains(df, ["k"], limit=1)


def test_months_without_activity_do_not_count(spark):
    day = dt.date
    rows = [("1", day(2020, 1, 3)), ("1", day(2020, 1, 9)), ("1", day(2020, 5, 1)), ("1", None)]
    rows += [(None, day(2020, 1, 1)), ("2", None)]
    g = spark.createDataFrame(rows, "customer_id string, transaction_date date")
    monthly = features.monthly_txn_counts(g)
    assert sorted(map(tuple, monthly.collect())) == [("1", 2020, 1, 2), ("1", 2020, 5, 1)]
    assert [tuple(r) for r in features.avg_txn_per_month(monthly).collect()] == [("1", 1.5)]


def test_first_row_puts_missing_last(spark):
    day = dt.date
    rows = [
        ("1", None, day(2020, 1, 1), "a", 1.0),
        ("1", "9", None, "b", 2.0),
        ("1", "9", day(2021, 1, 1), "c", 3.0),
        (None, "7", day(2020, 1, 1), "d", 4.0),
        (None, "8", day(2020, 1, 1), "e", 5.0),
    ]
    schema = "customer_id string, account_id string, transaction_date date, transaction_id string, transaction_amount double"
    got = features.first_row_per_customer(spark.createDataFrame(rows, schema))
    assert sorted(r["transaction_id"] for r in got.collect()) == ["c", "d"]


def test_account_grain_forms_equal_row_forms(spark, data_dir):
    t = fixtures.load_tables(spark, data_dir)
    accounts, g = gold.gold_accounts(t), gold.build_gold(t)

    def same(a, b):
        b = b.select(a.columns)
        return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

    assert same(
        features.monthly_txn_counts(g),
        features.monthly_txn_counts_by_account(accounts, t.transactions),
    )
    by_account = features.customer_features(accounts, t.transactions, FIXTURE_DOMAINS)
    by_row = features.first_row_per_customer(features.engineered_rows(g, FIXTURE_DOMAINS))
    assert same(by_row, by_account)
    assert by_account.count() == 122 == by_account.select("customer_id").distinct().count()
    groups = [
        F.max(sum(F.col(f"`{c}_{v}`") for v in values)).alias(c)
        for c, values in FIXTURE_DOMAINS.items()
    ]
    assert set(by_account.agg(*groups).first()) == {1}


def test_rows_are_dealt_by_customer_whatever_the_load(spark, data_dir):
    t = fixtures.load_tables(spark, data_dir)
    accounts, dealt = gold.gold_accounts(t), features.deal_transactions(t.transactions)
    # Small parts, and keys hot from 6 rows on: customers salted, their first rows found in two steps.
    tight = SkewPolicy(rows_per_task=6, rows_per_part=50)
    owners = features.owners_of(accounts, dealt, tight)
    assert owners.parts >= accounts.count() / 50 > 8 and owners.salts and not owners.hot_account
    assert features.owners_of(accounts.union(accounts), dealt, tight).parts > 1.5 * owners.parts
    plain = features.Owners(None, {}, False)
    for other in (owners, replace(owners, hot_account=True), replace(owners, salts={})):
        for made in (features.monthly_txn_counts_by_account, features.first_row_by_account):
            a, b = (made(accounts, t.transactions, dealt, o) for o in (plain, other))
            assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_account_grain_is_dealt_by_rows(spark, data_dir):
    t = fixtures.load_tables(spark, data_dir)
    dealt = gold.gold_accounts(t, SkewPolicy(rows_per_part=50))
    assert sorted(map(str, dealt.collect())) == sorted(map(str, gold.gold_accounts(t).collect()))
    assert "RepartitionByExpression" in dealt._jdf.queryExecution().optimizedPlan().toString()


def test_scalar_functions(spark):
    df = spark.createDataFrame([("a.b@c.d",), ("plain",)], "m string")
    assert [r[0] for r in df.select(scalars.user_prefix(F.col("m"))).collect()] == ["a_b_", "plain_"]
    dates = spark.createDataFrame([("2020-02-29",), ("no date",)], "t string")
    lenient = [r[0] for r in dates.select(scalars.parse_date(F.col("t"), strict=False)).collect()]
    assert lenient == [dt.date(2020, 2, 29), None]
    with pytest.raises(Exception):
        dates.select(scalars.parse_date(F.col("t"))).collect()
    p = spark.createDataFrame([(0.5,), (0.51,)], "p double")
    assert [r[0] for r in p.select(scalars.threshold_label(F.col("p"))).collect()] == [0, 1]


def test_customers_without_account_are_dealt_over_tasks(spark):
    day = dt.date(2020, 1, 1)
    owners = [(f"c{i}", None) for i in range(3_000)] + [("own", "7"), ("own", None), (None, None)]
    accounts = spark.createDataFrame(owners, "customer_id string, account_id string")
    paid = [(None, day), (None, day), (None, dt.date(2020, 2, 1)), ("7", day), (None, None)]
    transactions = spark.createDataFrame(paid, "account_id string, transaction_date date")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = features._owned_months(accounts, transactions)
        loads = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(loads) > 4 and max(r["count"] for r in loads) < 3_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    got = sorted(map(tuple, features.monthly_txn_counts_by_account(accounts, transactions).collect()))
    wanted = [(f"c{i}", 2020, m, n) for i in range(3_000) for m, n in ((1, 2), (2, 1))]
    assert got == sorted(wanted + [("own", 2020, 1, 3), ("own", 2020, 2, 1)])


def test_features_before_the_transactions_equal_features_after(spark, data_dir):
    t = fixtures.load_tables(spark, data_dir)
    wide = features.account_features(gold.gold_accounts(t), t.transactions, FIXTURE_DOMAINS)
    rows = gold.attach_transactions(wide, t.transactions, SkewPolicy(rows_per_task=20, pairs_per_task=200))
    after = features.engineered_rows(gold.build_gold(t), FIXTURE_DOMAINS)
    before = rows.select([f"`{c}`" for c in after.columns])
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


@pytest.mark.parametrize("name", ["engineered_rows", "attach_customer_agg"])
def test_rows_per_transaction_are_not_written(spark, data_dir, monkeypatch, name):
    written = []
    plain = registry.staged
    monkeypatch.setattr(registry, "staged", lambda df, to: written.append(df.columns) or plain(df, to))
    registry.QUERIES[name](spark, data_dir)
    assert written and not any("transaction_id" in c for c in written)


def _small_parts(spark):
    days = [dt.date(2020, 1 + i % 12, 1 + i % 28) for i in range(900)]
    paid = [(f"t{i}", float(i), days[i], None if i % 9 == 0 else "hot" if i % 3 else str(i)) for i in range(900)]
    paid += [("u", 1.0, None, "hot"), (None, None, None, None), ("v", 2.0, dt.date(2020, 1, 1), "hot")]
    schema = "transaction_id string, transaction_amount double, transaction_date date, account_id string"
    owners = [(f"c{i}", a) for i, a in enumerate([None, None, "hot", "1", "3", "none"])] + [(None, "5"), ("c2", "5")]
    return spark.createDataFrame(owners, "customer_id string, account_id string"), spark.createDataFrame(paid, schema)


def test_transactions_are_dealt_in_parts_that_do_not_grow(spark):
    _, paid = _small_parts(spark)
    policy = SkewPolicy(rows_per_task=50, rows_per_part=60)
    small, large = joins.deal(paid, "account_id", policy), joins.deal(paid.union(paid), "account_id", policy)
    assert (small.parts, large.parts) == (16, 31) and small.keys == ["account_id", "_salt"]
    loads = large.rows.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in loads) < 400  # of 1,202 rows of the hot account
    assert large.rows.drop("_salt").exceptAll(paid.union(paid)).isEmpty() and large.rows.count() == 1_806
    assert joins.deal(paid.limit(0), "account_id", policy).parts == 1


@pytest.mark.parametrize("most", [50, 100_000])
def test_dealt_transactions_give_the_same_months_and_first_rows(spark, most):
    accounts, paid = _small_parts(spark)
    dealt = joins.deal(paid, "account_id", SkewPolicy(rows_per_task=most, rows_per_part=60))
    assert (len(dealt.keys) == 2) == (most == 50)
    gold_rows = accounts.join(paid.withColumnRenamed("account_id", "a"), F.col("account_id").eqNullSafe(F.col("a")), "left")
    months = features.monthly_txn_counts(gold_rows)
    assert sorted(features.monthly_txn_counts_by_account(accounts, paid, dealt).collect()) == sorted(months.collect())
    first = features.first_row_by_account(accounts, paid, dealt)
    wanted = features.first_row_per_customer(gold_rows.drop("a")).select(first.columns)
    assert first.exceptAll(wanted).isEmpty() and first.count() == wanted.count() == accounts.select("customer_id").distinct().count()
