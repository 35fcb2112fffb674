"""The four sources: columns, how each is standardized, and its rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlake.functions import (
    currency,
    date,
    decimal,
    flag,
    lower_text,
    month,
    text,
    title,
    whole_number,
)
from churnlake.functions.standardize import NORMAL_MONTH, month_of
from churnlake.operators.rules import Rule

KNOWN_CUSTOMER = "_customer_exists"

# The allowed categories.
COUNTRIES = ("France", "Spain", "Germany")
GENDERS = ("Male", "Female")
ISSUE_TYPES = (
    "app_bug",
    "fee_dispute",
    "card_decline",
    "fraud_alert",
    "transfer_delay",
    "login_issue",
)
SEVERITIES = ("low", "medium", "high", "critical")
OFFER_TYPES = ("card_upgrade", "fee_waiver", "loan_rate_cut", "savings_bonus", "cashback")

integer = partial(whole_number, type_name="int")
long = partial(whole_number, type_name="long")


@dataclass(frozen=True)
class SourceSpec:
    """What the silver plan needs to know of one source.

    ``fields`` maps each column, in file order, to its standardizer. ``key`` is
    the business key; a second valid row with it gets ``duplicate_reason``.
    ``foreign_key`` names the column checked against the clean customers.
    """

    name: str
    fields: dict[str, Callable[[Column], Column]]
    key: str
    duplicate_reason: str
    rules: Callable[[Column], list[Rule]]
    file_format: str = "csv"
    header: bool = True
    foreign_key: str | None = None

    @property
    def columns(self) -> list[str]:
        return list(self.fields)


def _present(name: str, reason: str) -> Rule:
    return Rule(reason, F.col(name).isNotNull())


def _at_least_zero(name: str, reason: str) -> Rule:
    return Rule(reason, F.col(name) >= 0)


def _zero_or_one(name: str, reason: str) -> Rule:
    return Rule(reason, F.col(name).isin(0, 1))


def _customer_rules(as_of: Column) -> list[Rule]:
    return [
        _present("CustomerId", "missing_customer_id"),
        Rule("invalid_credit_score", F.col("CreditScore").between(300, 850)),
        _present("Surname", "missing_surname"),
        Rule("invalid_geography", F.col("Geography").isin(*COUNTRIES)),
        Rule("invalid_gender", F.col("Gender").isin(*GENDERS)),
        Rule("invalid_age", F.col("Age").between(18, 90)),
        Rule("invalid_tenure", (F.col("Tenure") >= 0) & (F.col("Tenure") < F.col("Age"))),
        _at_least_zero("Balance", "invalid_balance"),
        _at_least_zero("NumOfProducts", "invalid_num_products"),
        _zero_or_one("HasCrCard", "invalid_has_cr_card"),
        _zero_or_one("IsActiveMember", "invalid_active_member"),
        _at_least_zero("EstimatedSalary", "invalid_estimated_salary"),
        _zero_or_one("Exited", "invalid_exited"),
        _at_least_zero("tenure_months", "invalid_tenure_months"),
        Rule("invalid_date_opened", F.col("date_opened") <= as_of),
    ]


def _known_customer() -> list[Rule]:
    return [
        _present("customer_id", "missing_customer_id"),
        _present(KNOWN_CUSTOMER, "orphan_customer_id"),
    ]


def _ticket_rules(as_of: Column) -> list[Rule]:
    return [
        _present("ticket_id", "missing_ticket_id"),
        *_known_customer(),
        Rule("invalid_issue_type", F.col("issue_type").isin(*ISSUE_TYPES)),
        Rule("invalid_severity", F.col("severity").isin(*SEVERITIES)),
        Rule("invalid_resolution_time", F.col("resolution_time_hrs").between(0, 720)),
        Rule("invalid_created_at", F.col("created_at") <= as_of),
    ]


def _offer_rules(as_of: Column) -> list[Rule]:
    """Offers may name an unknown customer; the fact leaves those out."""
    return [
        _present("offer_id", "missing_offer_id"),
        _present("customer_id", "missing_customer_id"),
        Rule("invalid_offer_type", F.col("offer_type").isin(*OFFER_TYPES)),
        _zero_or_one("accepted", "invalid_accepted"),
        Rule("invalid_date_offered", F.col("date_offered") <= as_of),
    ]


def _usage_rules(as_of: Column) -> list[Rule]:
    in_time = F.col("usage_month") <= month_of(as_of)
    return [
        _present("usage_log_id", "missing_usage_log_id"),
        *_known_customer(),
        Rule("invalid_usage_month", F.col("usage_month").rlike(NORMAL_MONTH) & in_time),
        _present("product_type", "missing_product_type"),
        _at_least_zero("monthly_balance", "invalid_monthly_balance"),
        _at_least_zero("num_products", "invalid_num_products"),
    ]


CUSTOMERS = SourceSpec(
    name="customers",
    fields={
        "RowNumber": integer,
        "CustomerId": long,
        "Surname": text,
        "CreditScore": decimal,
        "Geography": title,
        "Gender": title,
        "Age": integer,
        "Tenure": integer,
        "Balance": currency,
        "NumOfProducts": integer,
        "HasCrCard": integer,
        "IsActiveMember": integer,
        "EstimatedSalary": currency,
        "Exited": integer,
        "tenure_months": integer,
        "date_opened": date,
    },
    key="CustomerId",
    duplicate_reason="duplicate_customer_id",
    rules=_customer_rules,
    header=False,
)

TICKETS = SourceSpec(
    name="customer_support_tickets",
    fields={
        "ticket_id": text,
        "customer_id": long,
        "issue_type": lower_text,
        "severity": lower_text,
        "resolution_time_hrs": decimal,
        "created_at": date,
    },
    key="ticket_id",
    duplicate_reason="duplicate_ticket_id",
    rules=_ticket_rules,
    foreign_key="customer_id",
)

OFFERS = SourceSpec(
    name="offers",
    fields={
        "offer_id": text,
        "customer_id": long,
        "offer_type": lower_text,
        "accepted": flag,
        "date_offered": date,
    },
    key="offer_id",
    duplicate_reason="duplicate_offer_id",
    rules=_offer_rules,
)

USAGE = SourceSpec(
    name="usage",
    fields={
        "usage_log_id": text,
        "customer_id": long,
        "usage_month": month,
        "product_type": lower_text,
        "monthly_balance": currency,
        "num_products": long,
    },
    key="usage_log_id",
    duplicate_reason="duplicate_usage_log_id",
    rules=_usage_rules,
    file_format="json",
    foreign_key="customer_id",
)

# Customers come first: tickets and usage are checked against them.
SOURCES = (CUSTOMERS, TICKETS, OFFERS, USAGE)
