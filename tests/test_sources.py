from __future__ import annotations

from accountrisk.functions.scoring import rule_probability, score_accounts
from accountrisk.schema import ACCOUNT_SCHEMA
from accountrisk.sources.accounts import read_accounts, write_accounts
from accountrisk.sources.mart import account_mart, account_snapshots
from conftest import SMALL
from pyspark.sql import functions as F


def test_round_trips_by_suffix(spark, accounts, tmp_path):
    df = accounts({}, {"nps_score": None, "customer_id": "ACC-2"})
    scored = score_accounts(df, rule_probability())
    for name in ("batch.csv", "batch.parquet"):
        path = write_accounts(scored, str(tmp_path / name))
        back = read_accounts(spark, path, scored.schema).select(*scored.columns)
        assert sorted(map(str, back.collect())) == sorted(map(str, scored.collect()))


def test_corrupt_csv_rows_are_kept(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("customer_id,contracted_seats\nA,5\nB,many\n")
    schema = ACCOUNT_SCHEMA.__class__(
        [f for f in ACCOUNT_SCHEMA.fields if f.name in ("customer_id", "contracted_seats")]
    )
    rows = {r["customer_id"]: r for r in read_accounts(spark, str(path), schema).collect()}
    assert rows["A"]["_corrupt_record"] is None and rows["A"]["contracted_seats"] == 5
    assert rows["B"]["_corrupt_record"] == "B,many" and rows["B"]["contracted_seats"] is None


def test_nan_becomes_null(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "nps_score double")
    path = str(tmp_path / "x.parquet")
    df.write.parquet(path)
    assert read_accounts(spark, path, df.schema).where(F.col("nps_score").isNull()).count() == 1


def test_mart_shape(mart):
    assert mart.count() == 150
    assert mart.select("customer_id").distinct().count() == 150
    row = mart.agg(F.avg("churn").alias("rate"), F.count_if(F.col("nps_score").isNull())).first()
    assert 0.08 < row["rate"] < 0.25 and row[1] == 34
    assert set(ACCOUNT_SCHEMA.names) == set(mart.columns)


def test_parquet_follows_the_declared_schema(spark, accounts, tmp_path):
    path = str(tmp_path / "old.parquet")
    accounts({}).drop("nps_score").withColumn("more", F.lit(1)).write.parquet(path)
    back = read_accounts(spark, path)
    assert back.columns == ACCOUNT_SCHEMA.names and back.first()["nps_score"] is None


def test_snapshots_come_from_one_scan(spark):
    """Two dates together give what each gives alone; every table is read once and no row is kept per brand."""
    days = ["1998-03-01", "2000-08-01"]
    both = account_snapshots(spark, SMALL, days)
    for day in days:
        alone = account_mart(spark, SMALL, day)
        part = both.where(F.col("snapshot") == day).drop("snapshot")
        assert sorted(map(repr, part.collect())) == sorted(map(repr, alone.collect())) and part.count() > 50
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderdate#") > 0 and plan.count("Expand") == 0
    scans = [line for line in plan.splitlines() if "Relation" in line]
    assert sum("o_orderkey" in line for line in scans) == 1 and sum("l_orderkey" in line for line in scans) == 1
