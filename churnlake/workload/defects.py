"""Seeded defects, stated once for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column -> expression that spoils some of its values; ``repeat`` is a condition
# whose rows occur twice.
DIM = {
    "cust_key": "CASE WHEN customer_id % 50 = 1 THEN NULL ELSE cust_key END",
    "customer_id": "CASE WHEN customer_id % 45 = 2 THEN NULL ELSE customer_id END",
    "is_churned": "CASE WHEN customer_id % 40 = 3 THEN 2 WHEN customer_id % 40 = 4 THEN NULL "
    "ELSE is_churned END",
    "CLV_LTV": "CASE WHEN customer_id % 35 = 5 THEN -1.0 ELSE CLV_LTV END",
    "avg_ticket_res_time_hrs": "CASE WHEN customer_id % 30 = 6 THEN -2.0 "
    "ELSE avg_ticket_res_time_hrs END",
    "repeat": "customer_id % 25 = 7",
}

FACT = {
    "activity_key": "CASE WHEN activity_key % 50 = 1 THEN NULL ELSE activity_key END",
    "cust_key": "CASE WHEN activity_key % 47 = 2 THEN NULL WHEN activity_key % 47 = 3 "
    "THEN cust_key + 1000000000 ELSE cust_key END",
    "customer_id": "CASE WHEN activity_key % 43 = 3 THEN NULL ELSE customer_id END",
    "activity_month": "CASE WHEN activity_key % 41 = 4 THEN '2001-13' "
    "WHEN activity_key % 41 = 5 THEN NULL ELSE activity_month END",
    "acceptance_rate": "CASE WHEN activity_key % 37 = 5 THEN 1.5 ELSE acceptance_rate END",
    "usage_events": "CASE WHEN activity_key % 31 = 6 THEN -1 ELSE usage_events END",
    "total_balance": "CASE WHEN activity_key % 29 = 7 THEN -1.0 ELSE total_balance END",
    "ticket_count": "CASE WHEN activity_key % 23 = 8 THEN -1 ELSE ticket_count END",
    "offer_count": "CASE WHEN activity_key % 19 = 9 THEN -3 ELSE offer_count END",
    "accepted_offers": "CASE WHEN activity_key % 17 = 10 THEN -2 WHEN activity_key % 17 = 11 "
    "THEN offer_count + 1 ELSE accepted_offers END",
    "repeat": "activity_key % 21 = 11",
}

MART = {
    "churn_rate": "CASE WHEN activity_month LIKE '%-02' THEN 1.25 ELSE churn_rate END",
    "churned_customers": "CASE WHEN activity_month LIKE '%-03' THEN active_customers + 1 "
    "ELSE churned_customers END",
    "repeat": "1 = 0",
}


def with_defects(df: DataFrame, spoiled: dict[str, str]) -> DataFrame:
    repeated = df.where(spoiled["repeat"])
    return df.unionByName(repeated).select(
        *[
            F.expr(spoiled[name]).alias(name) if name in spoiled else F.col(name)
            for name in df.columns
        ]
    )
