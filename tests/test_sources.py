import datetime as dt
import gzip

import pytest
from churnlens import schemas
from churnlens.sources import catalog, csv, inline, landing, sinks

CLOSED = "1,Attrited Customer,10\n2,Attrited Customer,20\n3,Attrited Customer,30\n"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_headerless_scan(spark, tmp_path):
    p = write(tmp_path / "closed.csv", CLOSED)
    got = csv.scan_typed_csv(spark, p, schemas.CLOSED_ACCOUNTS)
    assert got.schema == schemas.CLOSED_ACCOUNTS and got.count() == 3
    assert got.first()["customer_id"] == "1"


def test_header_read_as_data_becomes_a_row(spark, tmp_path):
    p = write(tmp_path / "t.csv", "transaction_id,transaction_amount,transaction_date,account_id\nt1,2.5,2020-01-02,7\n")
    wrong = csv.scan_typed_csv(spark, p, schemas.TRANSACTIONS).collect()
    assert len(wrong) == 2 and wrong[0]["transaction_amount"] is None
    right = csv.scan_typed_csv(spark, p, schemas.TRANSACTIONS, header=True).collect()
    assert [tuple(r) for r in right] == [("t1", 2.5, dt.date(2020, 1, 2), "7")]


def test_invisible_characters_in_names(spark, tmp_path):
    names = ",".join(schemas.CREDIT_METRICS.names).replace("ct_chng_Q4_Q1", "ct_chng_Q4_Q1​")
    p = write(tmp_path / "m.csv", names + "\n1,2,3,4,5,6,7\n")
    inferred = csv.scan_infer_csv(spark, p)
    assert inferred.columns == schemas.CREDIT_METRICS.names
    typed = csv.scan_header_csv(spark, p, schemas.CREDIT_METRICS)
    assert typed.first()["total_ct_chng_Q4_Q1"] == 6.0


def test_gzip_stage_with_row_numbers(spark, tmp_path):
    p = str(tmp_path / "stage.csv.gz")
    with gzip.open(p, "wt") as f:
        f.write(",customer_id,status,account_id\n0,1,Attrited Customer,10\n1,2,Attrited Customer,20\n")
    got = csv.scan_stage_csv(spark, p, schemas.CLOSED_ACCOUNTS, partitions=3)
    assert got.columns == schemas.CLOSED_ACCOUNTS.names
    assert sorted(r["account_id"] for r in got.collect()) == ["10", "20"]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", None, "x,y"), ("2", 'q"q', None)], "customer_id string, status string, account_id string")
    want = sorted(map(tuple, df.collect()), key=str)
    sinks.sink_csv(df, str(tmp_path / "c"))
    sinks.sink_gzip_csv(df.repartition(2), str(tmp_path / "g"))
    assert len(list((tmp_path / "g").glob("*.csv.gz"))) == 2
    for name in "cg":
        got = csv.scan_header_csv(spark, str(tmp_path / name), schemas.CLOSED_ACCOUNTS)
        assert sorted(map(tuple, got.collect()), key=str) == want
    stored = sinks.sink_stage_table(df, str(tmp_path / "s"))
    assert sorted(map(tuple, stored.collect()), key=str) == want
    assert csv.scan_stage_table(spark, str(tmp_path / "s")).count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = [f"bucket_test_{i}" for i in (1, 2)]
    try:
        a, b = (
            sinks.sink_bucketed_table(spark.range(50).withColumnRenamed("id", "k"), t, "k", 4)
            for t in tables
        )
        plan = a.join(b, "k")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and a.join(b, "k").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in tables:
            spark.sql(f"drop table if exists {t}")


def test_landing(spark, tmp_path):
    raw = {
        "closed": write(tmp_path / "closed.csv", CLOSED),
        "customer": write(tmp_path / "customer.csv", "1,40,F,2,,Single,100.5\n"),
        "account": write(tmp_path / "account.csv", "10,1,Blue,500,2015-01-01\n"),
        "metrics": write(tmp_path / "metrics.csv", ",".join(schemas.CREDIT_METRICS.names) + "\n1,2,3,4,5,6,0.5\n"),
        "transactions": write(tmp_path / "transactions.csv", "t,9.5,2020-01-02,10\n"),
    }
    landed = landing.land_raw(spark, raw, str(tmp_path / "landing"))
    assert landed.metrics.first()["avg_utilization_ratio"] == 0.5
    assert landed.customer.first()["education_level"] is None
    assert landing.read_landing(spark, str(tmp_path / "landing")).closed.count() == 3
    files = landing.list_landing(spark, str(tmp_path / "landing"), "*.parquet")
    assert {r["relative"].split("/")[0] for r in files.collect()} == set(schemas.SOURCES)
    assert files.columns == ["path", "length", "modificationTime", "relative"] and files.count() >= 5


def test_namespace(spark):
    before = spark.catalog.currentDatabase()
    try:
        catalog.setup_namespace(spark, "spark_catalog", "attrition_test")
        assert spark.catalog.currentDatabase() == "attrition_test"
        catalog.setup_namespace(spark, "spark_catalog", "attrition_test")
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("drop database if exists attrition_test")
    assert "spark_catalog" in {r[0] for r in catalog.list_catalogs(spark).collect()}


def test_inline(spark):
    scores = inline.published_scores(spark)
    assert scores.count() == 28
    assert {r["variable"] for r in scores.collect()} == set(schemas.feature_names(schemas.DOMAINS))
    top = scores.orderBy("score", ascending=False).first()
    assert top["variable"] == "avg_trans_per_month"
