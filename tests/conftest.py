from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from accountrisk.schema import ACCOUNT_SCHEMA  # noqa: E402
from accountrisk.session import build_session, written  # noqa: E402
from accountrisk.sources.mart import account_mart  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "accountrisk-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mart(spark):
    return written(account_mart(spark, SMALL), "mart")


#: A valid account of our own making, with few seats in use.
BASE_ACCOUNT = {
    "customer_id": "N-77",
    "industry": "HealthTech",
    "company_size_bracket": "11-50",
    "plan_tier": "Enterprise",
    "billing_cycle": "Annual",
    "payment_method": "Bank_Transfer",
    "auto_renew_enabled": False,
    "contract_duration_months": 9,
    "contracted_seats": 64,
    "active_users_last_30d": 8,
    "monthly_recurring_revenue": 2080.0,
    "avg_daily_logins": 6.0,
    "feature_adoption_score": 31.5,
    "storage_usage_pct": 47.0,
    "support_tickets_count": 7,
    "unresolved_tickets_count": 3,
    "nps_score": 4.0,
    "invoice_delay_days": 21.0,
    "churn": 0,
}


@pytest.fixture
def accounts(spark):
    """Build an account frame from overrides of one valid account."""

    def build(*overrides, without=()):
        rows = [{**BASE_ACCOUNT, **o} for o in (overrides or ({},))]
        names = ACCOUNT_SCHEMA.names
        df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ACCOUNT_SCHEMA)
        return df.drop(*without)

    return build
