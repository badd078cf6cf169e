from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from accountrisk.functions.contract import (
    require_rows,
    split_by_contract,
    violation_summary,
    with_default_id,
    with_violations,
)
from accountrisk.sources.mart import MART_CATEGORIES

from feeds import raw_feed


def codes(df, **kwargs):
    return [sorted(r["violations"]) for r in with_violations(df, **kwargs).collect()]


def test_valid_account_has_no_violations(accounts):
    assert codes(accounts()) == [[]]


def test_out_of_range_values(accounts):
    df = accounts({"nps_score": 15.0, "monthly_recurring_revenue": -50.0})
    assert codes(df) == [["monthly_recurring_revenue:range", "nps_score:range"]]


def test_nan_is_outside_every_range(accounts):
    assert codes(accounts({"monthly_recurring_revenue": math.nan})) == [
        ["monthly_recurring_revenue:range"]
    ]


def test_unknown_plan_and_bounds(accounts):
    df = accounts({"plan_tier": "Free-Trial"}, {"contract_duration_months": 0},
                  {"contract_duration_months": 120}, {"contracted_seats": 0})
    assert codes(df) == [["plan_tier:enum"], ["contract_duration_months:range"], [],
                         ["contracted_seats:range"]]


def test_nullable_fields_may_be_null_or_absent(accounts):
    assert codes(accounts({"nps_score": None, "storage_usage_pct": None})) == [[]]
    assert codes(accounts(without=["nps_score", "storage_usage_pct"])) == [[]]


def test_absent_required_fields_are_missing(accounts):
    found = codes(accounts().select("customer_id", "industry"))[0]
    assert len(found) == 14 and all(c.endswith(":missing") for c in found)


def test_allowed_sets_are_parameters(accounts):
    df = accounts({"industry": "BUILDING"})
    assert codes(df) == [["industry:enum"]]
    assert codes(df, categories={"industry": ["BUILDING"]}) == [[]]


def test_valid_and_quarantine_partition_the_input(mart):
    feed = raw_feed(mart)
    valid, rejected = split_by_contract(feed, MART_CATEGORIES)
    assert valid.count() + rejected.count() == feed.count()
    assert valid.select("customer_id").intersect(rejected.select("customer_id")).isEmpty()
    summary = violation_summary(rejected)
    assert summary.agg(F.sum("n_rows")).first()[0] == rejected.agg(
        F.sum(F.size("violations"))
    ).first()[0]


def test_default_id(accounts):
    df = accounts({"customer_id": None}, {})
    assert [r[0] for r in with_default_id(df).select("customer_id").collect()] == [
        "CUST-ONLINE-001", "N-77"
    ]
    assert with_default_id(accounts(without=["customer_id"])).first()["customer_id"]


def test_empty_batch_is_rejected(accounts):
    with pytest.raises(ValueError):
        require_rows(accounts().where("1 = 0"))
    assert require_rows(accounts()).count() == 1
