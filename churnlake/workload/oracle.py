"""The same queries in plain SQL, as chains of named subqueries."""

from __future__ import annotations

import re

from churnlake.plans.features import FEATURES
from churnlake.workload import defects
from churnlake.workload.raw import AS_OF, UNKNOWN

MONTH = r"\d{4}-(0[1-9]|1[0-2])"

COLUMNS = {
    "customers": (
        "RowNumber CustomerId Surname CreditScore Geography Gender Age Tenure Balance "
        "NumOfProducts HasCrCard IsActiveMember EstimatedSalary Exited tenure_months date_opened"
    ).split(),
    "tickets": "ticket_id customer_id issue_type severity resolution_time_hrs created_at".split(),
    "offers": "offer_id customer_id offer_type accepted date_offered".split(),
    "usage": (
        "usage_log_id customer_id usage_month product_type monthly_balance num_products"
    ).split(),
}
KEYS = {
    "customers": "CustomerId",
    "tickets": "ticket_id",
    "offers": "offer_id",
    "usage": "usage_log_id",
}


# --- raw cells ----------------------------------------------------------


def varchar(sql: str) -> str:
    return f"CAST({sql} AS VARCHAR)"


def money(cents: str) -> str:
    return (
        f"(CASE WHEN {cents} < 0 THEN '-$' ELSE '$' END || "
        f"format('{{:,}}', abs({cents}) // 100) || '.' || "
        f"lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0'))"
    )


def date_text(value: str, layout: str) -> str:
    return (
        f"CASE {layout} WHEN 0 THEN strftime({value}, '%Y-%m-%d') "
        f"WHEN 1 THEN strftime({value}, '%Y/%m/%d') "
        f"WHEN 2 THEN strftime({value}, '%d-%m-%Y') "
        f"WHEN 3 THEN strftime({value}, '%m/%d/%Y') "
        f"ELSE strftime({value}, '%d %b %Y') END"
    )


RAW_CUSTOMERS = f"""
SELECT CAST(c_custkey + 1 + CASE WHEN v = 2 THEN 1000000000 ELSE 0 END AS VARCHAR) AS RowNumber,
  CASE WHEN c_custkey % 97 = 13 THEN '   ' WHEN v = 1 THEN ' ' || c_custkey || ' '
    ELSE {varchar("c_custkey")} END AS CustomerId,
  CASE WHEN c_custkey % 89 = 7 THEN ' ' WHEN v = 1 THEN '  ' || c_name ELSE c_name END AS Surname,
  CASE WHEN c_custkey % 61 = 4 THEN '299' WHEN c_custkey % 67 = 9 THEN 'n/a'
    ELSE CAST(300 + (c_custkey * 7 + CASE WHEN v = 2 THEN 1 ELSE 0 END) % 551 AS VARCHAR)
    END AS CreditScore,
  CASE c_custkey % 3 WHEN 0 THEN upper(country) WHEN 1 THEN lower(country) ELSE country
    END AS Geography,
  CASE WHEN c_custkey % 71 = 5 THEN 'X' WHEN c_custkey % 2 = 0 THEN 'MALE' ELSE 'female'
    END AS Gender,
  CASE WHEN c_custkey % 53 = 2 THEN '17' WHEN c_custkey % 59 = 3 THEN '17.9'
    WHEN c_custkey % 11 = 0 THEN age || '.0' ELSE {varchar("age")} END AS Age,
  CASE WHEN c_custkey % 79 = 8 THEN {varchar("age")} ELSE {varchar("c_custkey % 12")} END AS Tenure,
  {money("cents")} AS Balance,
  {varchar("c_nationkey % 4 + 1")} AS NumOfProducts,
  CASE WHEN c_custkey % 101 = 11 THEN '2' ELSE {varchar("c_custkey % 2")} END AS HasCrCard,
  CASE WHEN c_custkey % 103 = 12 THEN 'x' WHEN c_custkey % 3 = 0 THEN '1' ELSE '0'
    END AS IsActiveMember,
  CASE WHEN c_custkey % 107 = 6 THEN '-1' ELSE '$' || (c_custkey * 31 % 150000) || '.50'
    END AS EstimatedSalary,
  CASE WHEN c_custkey % 109 = 10 THEN '7' WHEN c_acctbal < 1000 THEN '1' ELSE '0' END AS Exited,
  CASE WHEN c_custkey % 113 = 21 THEN '-3' ELSE {varchar("c_custkey % 12 * 12")}
    END AS tenure_months,
  CASE WHEN c_custkey % 83 = 9 THEN 'junk' WHEN c_custkey % 127 = 30 THEN '2090-01-01'
    ELSE {date_text("opened", "c_custkey % 5")} END AS date_opened,
  c_custkey * 4 + v AS sid
FROM (
  SELECT *, 18 + c_custkey % 73 AS age, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
    DATE '1990-01-01' + CAST(c_custkey % 4000 AS INTEGER) AS opened,
    CASE WHEN c_nationkey = 24 THEN 'Italy' WHEN c_nationkey % 3 = 0 THEN 'France'
      WHEN c_nationkey % 3 = 1 THEN 'Spain' ELSE 'Germany' END AS country
  FROM customer
) c, (VALUES (0), (1), (2)) versions(v)
WHERE v = 0 OR (v = 1 AND c_custkey % 10 = 0) OR (v = 2 AND c_custkey % 14 = 1)
"""

RAW_USAGE = f"""
SELECT CASE WHEN o_orderkey % 89 = 17 THEN '' WHEN v = 1 THEN ' USG' || o_orderkey
    ELSE 'USG' || o_orderkey END AS usage_log_id,
  CASE WHEN o_orderkey % 73 = 5 THEN NULL
    WHEN o_orderkey % 50 = 7 THEN {varchar(f"o_custkey + {UNKNOWN}")}
    ELSE {varchar("o_custkey")} END AS customer_id,
  CASE WHEN o_orderkey % 101 = 3 THEN '2025-13' WHEN o_orderkey % 131 = 40 THEN '2090-01'
    WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m')
    WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y/%m')
    ELSE strftime(o_orderdate, '%m/%Y') END AS usage_month,
  CASE WHEN o_orderkey % 61 = 60 THEN ' ' ELSE o_orderpriority END AS product_type,
  CASE WHEN o_orderkey % 97 = 20 THEN '-$1.00' WHEN o_orderkey % 139 = 41 THEN 'abc'
    ELSE {money("cents")} END AS monthly_balance,
  CASE WHEN o_orderkey % 149 = 50 THEN '' ELSE {varchar("o_custkey % 4")} END AS num_products,
  o_orderkey * 4 + v AS sid
FROM (
  SELECT *, CAST(floor(o_totalprice / 2) AS BIGINT) + CASE WHEN v = 2 THEN 100 ELSE 0 END AS cents
  FROM orders, (VALUES (0), (1), (2)) versions(v)
) o
WHERE v = 0 OR (v = 1 AND o_orderkey % 20 = 0) OR (v = 2 AND o_orderkey % 33 = 1)
"""

LINE_ID = "l_orderkey || '-' || l_linenumber"
LINE_CUSTOMER = (
    f"CASE WHEN l_orderkey % 67 = 3 THEN ' ' WHEN l_orderkey % 60 = 9 "
    f"THEN {varchar(f'l_partkey * 3 // 4 + {UNKNOWN}')} "
    f"ELSE {varchar('l_partkey * 3 // 4')} END"
)
LINE_DATE = (
    "CASE WHEN (l_suppkey + l_partkey) % 97 = 11 THEN '2001-02-30' "
    "WHEN l_partkey % 101 = 33 THEN '2090-05-01' "
    f"ELSE {date_text('l_shipdate', 'l_linenumber % 5')} END"
)
LINE_ORDER = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, v, l_shipdate) AS sid"
LINES = """FROM lineitem, (VALUES (0), (1)) versions(v)
WHERE (v = 0 OR (l_orderkey + l_linenumber) % 25 = 0) AND """
TICKET_LINES = "(l_returnflag = 'R' OR (l_returnflag = 'N' AND l_orderkey % 2 = 0))"

RAW_TICKETS = f"""
SELECT CASE WHEN (l_orderkey * 3 + l_suppkey) % 89 = 7 THEN ''
    WHEN v = 1 THEN {LINE_ID} || '  ' ELSE {LINE_ID} END AS ticket_id,
  {LINE_CUSTOMER} AS customer_id,
  CASE WHEN (l_suppkey + l_linenumber) % 37 = 5 THEN 'other' ELSE CASE l_linenumber
    WHEN 1 THEN 'App_Bug' WHEN 2 THEN 'fee_dispute' WHEN 3 THEN 'CARD_DECLINE'
    WHEN 4 THEN 'fraud_alert' WHEN 5 THEN 'transfer_delay' WHEN 6 THEN 'login_issue'
    ELSE 'app_bug' END END AS issue_type,
  CASE WHEN l_partkey % 53 = 4 THEN 'urgent' ELSE CASE l_suppkey % 4 WHEN 0 THEN 'Low'
    WHEN 1 THEN 'MEDIUM' WHEN 2 THEN ' high ' ELSE 'critical' END END AS severity,
  CASE WHEN l_partkey % 47 = 6 THEN '720.5' WHEN l_partkey % 43 = 8 THEN 'soon'
    WHEN l_partkey % 41 = 0 THEN '720'
    ELSE (CAST(l_quantity AS BIGINT) * 3 // 2)
      || CASE WHEN CAST(l_quantity AS BIGINT) % 2 = 1 THEN '.5' ELSE '.0' END
    END AS resolution_time_hrs,
  {LINE_DATE} AS created_at,
  {LINE_ORDER}
{LINES} {TICKET_LINES}
"""

RAW_OFFERS = f"""
SELECT CASE WHEN (l_orderkey * 3 + l_suppkey) % 89 = 7 THEN ''
    WHEN v = 1 THEN ' ' || {LINE_ID} ELSE {LINE_ID} END AS offer_id,
  {LINE_CUSTOMER} AS customer_id,
  CASE WHEN l_partkey % 59 = 7 THEN 'freebie' ELSE CASE l_linenumber % 5
    WHEN 0 THEN 'Card_Upgrade' WHEN 1 THEN 'fee_waiver' WHEN 2 THEN 'LOAN_RATE_CUT'
    WHEN 3 THEN 'savings_bonus' ELSE 'cashback' END END AS offer_type,
  CASE WHEN l_partkey % 71 = 9 THEN 'maybe'
    WHEN l_linestatus = 'F' THEN CASE l_linenumber % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'y'
      WHEN 2 THEN '1' ELSE 'True' END
    ELSE CASE l_linenumber % 4 WHEN 0 THEN 'no' WHEN 1 THEN 'N' WHEN 2 THEN '0'
      ELSE 'false' END END AS accepted,
  {LINE_DATE} AS date_offered,
  {LINE_ORDER}
{LINES} NOT {TICKET_LINES}
"""


# --- standardized cells -------------------------------------------------


def text(column: str) -> str:
    return f"nullif(trim({column}, ' '), '')"


def title(column: str) -> str:
    cell = text(column)
    return f"upper(left({cell}, 1)) || lower(substr({cell}, 2))"


def lower(column: str) -> str:
    return f"lower({text(column)})"


def decimal(column: str) -> str:
    return f"TRY_CAST({text(column)} AS DOUBLE)"


def currency(column: str) -> str:
    return f"TRY_CAST(replace(replace({text(column)}, '$', ''), ',', '') AS DOUBLE)"


def whole(column: str, kind: str = "INTEGER") -> str:
    """A plain cast would round 12.7 to 13."""
    cell = text(column)
    return (
        f"CASE WHEN regexp_full_match({cell}, '[+-]?\\d+(\\.\\d*)?') "
        f"THEN TRY_CAST(regexp_extract({cell}, '^[+-]?\\d+') AS {kind}) END"
    )


def date(column: str) -> str:
    cell = text(column)
    layouts = (
        (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
        (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"),
        (r"\d{2}-\d{2}-\d{4}", "%d-%m-%Y"),
        (r"\d{2}/\d{2}/\d{4}", "%m/%d/%Y"),
        (r"\d{2} [A-Za-z]{3} \d{4}", "%d %b %Y"),
    )
    cases = " ".join(
        f"WHEN regexp_full_match({cell}, '{pattern}') "
        f"THEN CAST(try_strptime({cell}, '{layout}') AS DATE)"
        for pattern, layout in layouts
    )
    return f"CASE {cases} END"


def flag(column: str) -> str:
    return (
        f"CASE WHEN {lower(column)} IN ('1', 'yes', 'y', 'true') THEN 1 "
        f"WHEN {lower(column)} IN ('0', 'no', 'n', 'false') THEN 0 END"
    )


def month(column: str) -> str:
    cell = text(column)
    return (
        f"CASE WHEN regexp_full_match({cell}, '\\d{{4}}[-/](0[1-9]|1[0-2])') "
        f"THEN replace({cell}, '/', '-') "
        f"WHEN regexp_full_match({cell}, '(0[1-9]|1[0-2])/\\d{{4}}') "
        f"THEN right({cell}, 4) || '-' || left({cell}, 2) END"
    )


STANDARD = {
    "customers": {
        "RowNumber": whole("RowNumber"),
        "CustomerId": whole("CustomerId", "BIGINT"),
        "Surname": text("Surname"),
        "CreditScore": decimal("CreditScore"),
        "Geography": title("Geography"),
        "Gender": title("Gender"),
        "Age": whole("Age"),
        "Tenure": whole("Tenure"),
        "Balance": currency("Balance"),
        "NumOfProducts": whole("NumOfProducts"),
        "HasCrCard": whole("HasCrCard"),
        "IsActiveMember": whole("IsActiveMember"),
        "EstimatedSalary": currency("EstimatedSalary"),
        "Exited": whole("Exited"),
        "tenure_months": whole("tenure_months"),
        "date_opened": date("date_opened"),
    },
    "tickets": {
        "ticket_id": text("ticket_id"),
        "customer_id": whole("customer_id", "BIGINT"),
        "issue_type": lower("issue_type"),
        "severity": lower("severity"),
        "resolution_time_hrs": decimal("resolution_time_hrs"),
        "created_at": date("created_at"),
    },
    "offers": {
        "offer_id": text("offer_id"),
        "customer_id": whole("customer_id", "BIGINT"),
        "offer_type": lower("offer_type"),
        "accepted": flag("accepted"),
        "date_offered": date("date_offered"),
    },
    "usage": {
        "usage_log_id": text("usage_log_id"),
        "customer_id": whole("customer_id", "BIGINT"),
        "usage_month": month("usage_month"),
        "product_type": lower("product_type"),
        "monthly_balance": currency("monthly_balance"),
        "num_products": whole("num_products", "BIGINT"),
    },
}

ORPHAN = "customer_id NOT IN (SELECT CustomerId FROM clean_customers)"

# (condition of a bad row, reason), first match wins.
BAD = {
    "customers": [
        ("CustomerId IS NULL", "missing_customer_id"),
        ("CreditScore IS NULL OR CreditScore < 300 OR CreditScore > 850", "invalid_credit_score"),
        ("Surname IS NULL", "missing_surname"),
        (
            "Geography IS NULL OR Geography NOT IN ('France', 'Spain', 'Germany')",
            "invalid_geography",
        ),
        ("Gender IS NULL OR Gender NOT IN ('Male', 'Female')", "invalid_gender"),
        ("Age IS NULL OR Age < 18 OR Age > 90", "invalid_age"),
        ("Tenure IS NULL OR Tenure < 0 OR Tenure >= Age", "invalid_tenure"),
        ("Balance IS NULL OR Balance < 0", "invalid_balance"),
        ("NumOfProducts IS NULL OR NumOfProducts < 0", "invalid_num_products"),
        ("HasCrCard IS NULL OR HasCrCard NOT IN (0, 1)", "invalid_has_cr_card"),
        ("IsActiveMember IS NULL OR IsActiveMember NOT IN (0, 1)", "invalid_active_member"),
        ("EstimatedSalary IS NULL OR EstimatedSalary < 0", "invalid_estimated_salary"),
        ("Exited IS NULL OR Exited NOT IN (0, 1)", "invalid_exited"),
        ("tenure_months IS NULL OR tenure_months < 0", "invalid_tenure_months"),
        (f"date_opened IS NULL OR date_opened > DATE '{AS_OF}'", "invalid_date_opened"),
    ],
    "tickets": [
        ("ticket_id IS NULL", "missing_ticket_id"),
        ("customer_id IS NULL", "missing_customer_id"),
        (ORPHAN, "orphan_customer_id"),
        (
            "issue_type IS NULL OR issue_type NOT IN ('app_bug', 'fee_dispute', 'card_decline', "
            "'fraud_alert', 'transfer_delay', 'login_issue')",
            "invalid_issue_type",
        ),
        (
            "severity IS NULL OR severity NOT IN ('low', 'medium', 'high', 'critical')",
            "invalid_severity",
        ),
        (
            "resolution_time_hrs IS NULL OR resolution_time_hrs < 0 OR resolution_time_hrs > 720",
            "invalid_resolution_time",
        ),
        (f"created_at IS NULL OR created_at > DATE '{AS_OF}'", "invalid_created_at"),
    ],
    "offers": [
        ("offer_id IS NULL", "missing_offer_id"),
        ("customer_id IS NULL", "missing_customer_id"),
        (
            "offer_type IS NULL OR offer_type NOT IN ('card_upgrade', 'fee_waiver', "
            "'loan_rate_cut', 'savings_bonus', 'cashback')",
            "invalid_offer_type",
        ),
        ("accepted IS NULL", "invalid_accepted"),
        (f"date_offered IS NULL OR date_offered > DATE '{AS_OF}'", "invalid_date_offered"),
    ],
    "usage": [
        ("usage_log_id IS NULL", "missing_usage_log_id"),
        ("customer_id IS NULL", "missing_customer_id"),
        (ORPHAN, "orphan_customer_id"),
        (
            f"usage_month IS NULL OR NOT regexp_full_match(usage_month, '{MONTH}') "
            f"OR usage_month > '{AS_OF[:7]}'",
            "invalid_usage_month",
        ),
        ("product_type IS NULL", "missing_product_type"),
        ("monthly_balance IS NULL OR monthly_balance < 0", "invalid_monthly_balance"),
        ("num_products IS NULL OR num_products < 0", "invalid_num_products"),
    ],
}

DUPLICATE = {
    "customers": "duplicate_customer_id",
    "tickets": "duplicate_ticket_id",
    "offers": "duplicate_offer_id",
    "usage": "duplicate_usage_log_id",
}

SUBQUERIES: dict[str, str] = {
    "raw_customers": RAW_CUSTOMERS,
    "raw_tickets": RAW_TICKETS,
    "raw_offers": RAW_OFFERS,
    "raw_usage": RAW_USAGE,
}


def reason_case(source: str) -> str:
    return " ".join(f"WHEN {bad} THEN '{reason}'" for bad, reason in BAD[source])


for _name, _columns in COLUMNS.items():
    _list = ", ".join(_columns)
    _cells = ", ".join(f"{sql} AS {column}" for column, sql in STANDARD[_name].items())
    SUBQUERIES[f"std_{_name}"] = f"SELECT {_cells}, sid FROM raw_{_name}"
    SUBQUERIES[f"numbered_{_name}"] = (
        f"SELECT *, row_number() OVER (PARTITION BY {_list} ORDER BY sid) AS copy_number, "
        f"count(*) OVER (PARTITION BY {_list}) AS copies FROM std_{_name}"
    )
    SUBQUERIES[f"ruled_{_name}"] = (
        f"SELECT *, CASE WHEN copy_number > 1 THEN 'exact_duplicate' {reason_case(_name)} END "
        f"AS reason FROM numbered_{_name}"
    )
    SUBQUERIES[f"silver_{_name}"] = (
        f"SELECT {_list}, CASE WHEN reason IS NOT NULL THEN reason "
        f"WHEN row_number() OVER (PARTITION BY {KEYS[_name]}, reason IS NULL ORDER BY sid) > 1 "
        f"THEN '{DUPLICATE[_name]}' END AS rejection_reason FROM ruled_{_name}"
    )
    SUBQUERIES[f"clean_{_name}"] = (
        f"SELECT {_list} FROM silver_{_name} WHERE rejection_reason IS NULL"
    )


# --- gold ---------------------------------------------------------------

SUBQUERIES |= {
    "clv": """
SELECT customer_id, avg(monthly_balance) * count(DISTINCT usage_month) AS CLV_LTV
FROM clean_usage GROUP BY customer_id""",
    "ticket_avg": """
SELECT customer_id, avg(resolution_time_hrs) AS avg_ticket_res_time_hrs
FROM clean_tickets GROUP BY customer_id""",
    "usage_monthly": """
SELECT customer_id, usage_month AS activity_month, count(usage_log_id) AS usage_events,
  sum(monthly_balance) AS total_balance, avg(monthly_balance) AS avg_balance
FROM clean_usage GROUP BY ALL""",
    "tickets_monthly": """
SELECT customer_id, strftime(created_at, '%Y-%m') AS activity_month,
  count(ticket_id) AS ticket_count, avg(resolution_time_hrs) AS avg_resolution_time
FROM clean_tickets GROUP BY ALL""",
    "offers_monthly": """
SELECT customer_id, strftime(date_offered, '%Y-%m') AS activity_month,
  count(offer_id) AS offer_count, CAST(sum(accepted) AS BIGINT) AS accepted_offers,
  avg(CAST(accepted AS DOUBLE)) AS acceptance_rate
FROM clean_offers GROUP BY ALL""",
    "spine": """
SELECT customer_id, activity_month FROM (
  SELECT customer_id, activity_month FROM usage_monthly
  UNION SELECT customer_id, activity_month FROM tickets_monthly
  UNION SELECT customer_id, activity_month FROM offers_monthly)
WHERE customer_id IN (SELECT CustomerId FROM clean_customers)""",
    "dim": """
SELECT row_number() OVER (ORDER BY CustomerId) AS cust_key, CustomerId AS customer_id,
  Exited AS is_churned, coalesce(CLV_LTV, 0.0) AS CLV_LTV,
  coalesce(avg_ticket_res_time_hrs, 0.0) AS avg_ticket_res_time_hrs,
  NumOfProducts AS num_products, DATE '2026-09-03' AS dw_start_date,
  DATE '9999-12-31' AS dw_end_date
FROM clean_customers c
LEFT JOIN clv ON clv.customer_id = c.CustomerId
LEFT JOIN ticket_avg t ON t.customer_id = c.CustomerId""",
    "fact": """
SELECT customer_id, activity_month, coalesce(usage_events, 0) AS usage_events,
  coalesce(total_balance, 0.0) AS total_balance, coalesce(avg_balance, 0.0) AS avg_balance,
  coalesce(ticket_count, 0) AS ticket_count,
  coalesce(avg_resolution_time, 0.0) AS avg_resolution_time,
  coalesce(offer_count, 0) AS offer_count, coalesce(accepted_offers, 0) AS accepted_offers,
  coalesce(acceptance_rate, 0.0) AS acceptance_rate, cust_key,
  row_number() OVER (ORDER BY customer_id, activity_month) AS activity_key
FROM spine
LEFT JOIN usage_monthly USING (customer_id, activity_month)
LEFT JOIN tickets_monthly USING (customer_id, activity_month)
LEFT JOIN offers_monthly USING (customer_id, activity_month)
JOIN (SELECT customer_id, cust_key FROM dim) USING (customer_id)""",
    "mart": """
SELECT activity_month, count(DISTINCT customer_id) AS active_customers,
  count(DISTINCT CASE WHEN is_churned = 1 THEN customer_id END) AS churned_customers,
  count(DISTINCT CASE WHEN is_churned = 1 THEN customer_id END)
    / count(DISTINCT customer_id) AS churn_rate
FROM fact JOIN (SELECT customer_id, is_churned FROM dim) USING (customer_id)
GROUP BY activity_month""",
}


def spoiled(table: str, columns: str, plan: dict[str, str]) -> str:
    cells = ", ".join(
        f"{plan[name]} AS {name}" if name in plan else name for name in columns.split()
    )
    return (
        f"SELECT {cells} FROM (SELECT * FROM {table} UNION ALL "
        f"SELECT * FROM {table} WHERE {plan['repeat']}) AS t"
    )


DIM_COLUMNS = "cust_key customer_id is_churned CLV_LTV avg_ticket_res_time_hrs num_products"
FACT_COLUMNS = (
    "customer_id activity_month usage_events total_balance avg_balance ticket_count "
    "avg_resolution_time offer_count accepted_offers acceptance_rate cust_key activity_key"
)
MART_COLUMNS = "activity_month active_customers churned_customers churn_rate"

SUBQUERIES |= {
    "bad_dim": spoiled("dim", DIM_COLUMNS, defects.DIM),
    "bad_fact": spoiled("fact", FACT_COLUMNS, defects.FACT),
    "bad_mart": spoiled("mart", MART_COLUMNS, defects.MART),
}


def quality(dim: str, fact: str, mart: str) -> str:
    def rows(table: str, name: str, check: str, condition: str) -> str:
        return (
            f"SELECT '{name}' AS table_name, '{check}' AS check_name, "
            f"count(*) AS offenders FROM {table} WHERE {condition}"
        )

    def repeated(table: str, name: str, check: str, key: str) -> str:
        return (
            f"SELECT '{name}', '{check}', count(*) FROM "
            f"(SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"
        )

    d, f, m = "dim_customer", "fact_customer_activity", "monthly_churn_rate"
    parts = [
        rows(dim, d, "null_cust_key", "cust_key IS NULL"),
        rows(dim, d, "null_customer_id", "customer_id IS NULL"),
        rows(dim, d, "invalid_is_churned", "is_churned IS NULL OR is_churned NOT IN (0, 1)"),
        rows(dim, d, "negative_clv_ltv", "CLV_LTV < 0"),
        rows(dim, d, "negative_avg_ticket_res_time", "avg_ticket_res_time_hrs < 0"),
        repeated(dim, d, "duplicate_cust_key", "cust_key"),
        repeated(dim, d, "duplicate_customer_id", "customer_id"),
        rows(fact, f, "null_activity_key", "activity_key IS NULL"),
        rows(fact, f, "null_cust_key", "cust_key IS NULL"),
        rows(fact, f, "null_customer_id", "customer_id IS NULL"),
        rows(
            fact,
            f,
            "invalid_activity_month",
            f"activity_month IS NULL OR NOT regexp_full_match(activity_month, '{MONTH}')",
        ),
        rows(fact, f, "invalid_acceptance_rate", "acceptance_rate < 0 OR acceptance_rate > 1"),
        rows(fact, f, "negative_usage_events", "usage_events < 0"),
        rows(fact, f, "negative_total_balance", "total_balance < 0"),
        rows(fact, f, "negative_ticket_count", "ticket_count < 0"),
        rows(fact, f, "negative_offer_count", "offer_count < 0"),
        rows(fact, f, "negative_accepted_offers", "accepted_offers < 0"),
        rows(fact, f, "accepted_above_offered", "accepted_offers > offer_count"),
        repeated(fact, f, "duplicate_activity_key", "activity_key"),
        repeated(fact, f, "duplicate_customer_month", "customer_id, activity_month"),
        f"SELECT '{f}', 'orphan_cust_key', count(*) FROM (SELECT DISTINCT cust_key FROM {fact}) o "
        f"WHERE NOT EXISTS (SELECT 1 FROM {dim} p WHERE p.cust_key = o.cust_key)",
        rows(mart, m, "invalid_churn_rate", "churn_rate < 0 OR churn_rate > 1"),
        rows(mart, m, "churned_above_active", "churned_customers > active_customers"),
    ]
    return (
        "SELECT *, CASE WHEN offenders = 0 THEN 'PASS' ELSE 'CHECK' END AS status FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


# --- assembling ---------------------------------------------------------


def half_up(sql: str, places: int = 2) -> str:
    """Rounding a double directly would take 2.675 down."""
    return f"CAST(round(CAST({sql} AS DECIMAL(38, 10)), {places}) AS DOUBLE)"


def big(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"


def with_chain(final: str) -> str:
    """Put the subqueries that ``final`` names, and those they name, in front."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        words = set(re.findall(r"\w+", sql))
        for name, body in SUBQUERIES.items():
            if name in words and name not in needed:
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final.strip()
    chain = ",\n".join(f"{name} AS MATERIALIZED ({SUBQUERIES[name]})" for name in needed)
    return f"WITH {chain}\n{final.strip()}"


def _segment(column: str, high: str, middle: str, low: str, cuts: tuple[int, int]) -> str:
    return (
        f"CASE WHEN {column} >= {cuts[0]} THEN '{high}' "
        f"WHEN {column} >= {cuts[1]} THEN '{middle}' ELSE '{low}' END"
    )


def _churn_by_total(measure: str, name: str, segment: str) -> str:
    return f"""
SELECT {segment} AS {name}, count(*) AS customers, {big("sum(is_churned)")} AS churned_customers,
  {half_up("avg(is_churned) * 100")} AS churn_rate
FROM (SELECT customer_id, sum({measure}) AS total FROM fact GROUP BY customer_id)
JOIN dim USING (customer_id) GROUP BY ALL"""


FEATURE_QUERY = """
SELECT d.customer_id, d.is_churned, d.CLV_LTV, d.avg_ticket_res_time_hrs, d.num_products,
  a.* EXCLUDE (customer_id), l.* EXCLUDE (customer_id)
FROM dim d
LEFT JOIN (
  SELECT customer_id, count(DISTINCT activity_month) AS months_active,
    CAST(sum(usage_events) AS BIGINT) AS total_usage_events,
    avg(usage_events) AS avg_usage_events, avg(total_balance) AS avg_total_balance,
    avg(avg_balance) AS avg_balance_mean, CAST(sum(ticket_count) AS BIGINT) AS total_tickets,
    avg(avg_resolution_time) AS avg_resolution_time_mean,
    CAST(sum(offer_count) AS BIGINT) AS total_offers,
    CAST(sum(accepted_offers) AS BIGINT) AS total_accepted_offers,
    avg(acceptance_rate) AS avg_acceptance_rate
  FROM fact GROUP BY customer_id) a USING (customer_id)
LEFT JOIN last_month l USING (customer_id)"""



def _split_rows(customers: str) -> str:
    return f"""
SELECT customer_id, is_churned, CASE WHEN row_number() OVER (
    PARTITION BY is_churned ORDER BY md5('42:' || customer_id), customer_id)
  <= round(0.2 * count(*) OVER (PARTITION BY is_churned)) THEN 'test' ELSE 'train' END AS split
FROM {customers}"""


SUBQUERIES |= {
    "split_rows": _split_rows("dim"),
    "separable_rows": _split_rows(
        "(SELECT customer_id, CAST(num_products >= 3 AS INTEGER) AS is_churned FROM dim)"
    ),
    "last_month": """
SELECT customer_id, usage_events AS last_usage_events, total_balance AS last_total_balance,
  ticket_count AS last_ticket_count
FROM fact
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY activity_month DESC) = 1""",
    "feature_rows": FEATURE_QUERY,
    "rule_rows": """
SELECT is_churned AS actual_churn,
  CASE WHEN coalesce(total_accepted_offers, 0) < 6 THEN 1 ELSE 0 END AS predicted_churn,
  -coalesce(total_accepted_offers, 0) AS score
FROM feature_rows""",
}

_ROUNDED_FEATURES = {
    name
    for name in FEATURES
    if name == "CLV_LTV" or name.startswith("avg_") or name == "last_total_balance"
}


def _silver(source: str) -> str:
    return f"SELECT * FROM silver_{source}"


def _validated(source: str) -> str:
    return f"""
SELECT {", ".join(COLUMNS[source])}, copies, reason AS rejection_reason
FROM ruled_{source} WHERE copy_number = 1"""


_DATASETS = {
    "customers": "customers",
    "tickets": "customer_support_tickets",
    "offers": "offers",
    "usage": "usage",
}


def _fingerprint() -> str:
    """JSON of the fields that are present, text quoted and numbers not."""
    texts = ("usage_log_id", "usage_month", "product_type")
    fields = ", ".join(
        f"""'"{name}":"' || {name} || '"'""" if name in texts else f"""'"{name}":' || {name}"""
        for name in COLUMNS["usage"]
    )
    return (
        "SELECT sid AS row_id, sha256('{' || concat_ws(',', " + fields + ") || '}') AS row_hash "
        "FROM std_usage"
    )


_CHURNED_FACT = "(SELECT * FROM fact WHERE customer_id IN (SELECT customer_id FROM dim WHERE is_churned = 1))"

FINAL: dict[str, str] = {
    "bronze_csv_scan": f"SELECT {', '.join(COLUMNS['customers'])} FROM raw_customers",
    # An empty CSV cell is read as NULL.
    "bronze_csv_header_scan": (
        "SELECT * REPLACE (nullif(offer_id, '') AS offer_id) FROM "
        f"(SELECT {', '.join(COLUMNS['offers'])} FROM raw_offers)"
    ),
    "bronze_json_scan": (
        "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS num_products) FROM "
        f"(SELECT {', '.join(COLUMNS['usage'])} FROM raw_usage)"
    ),
    "bronze_json_array_scan": (
        "SELECT *, CAST(NULL AS VARCHAR) AS num_products, "
        "'\"}, {[\\\" \\\\ ]}' || chr(10) || '}' || usage_log_id AS note, "
        "'{\"of\":{' || coalesce('\"customer_id\":\"' || customer_id || '\"', '') || '},\"n\":1}' AS inner "
        f"FROM (SELECT {', '.join(COLUMNS['usage'][:-1])} FROM raw_usage)"
    ),
    "bronze_arrival_ids": (
        "SELECT RowNumber, CustomerId, "
        "row_number() OVER (ORDER BY (sid // 4) % 7 DESC, sid) AS arrival_id FROM raw_customers"
    ),
    "stream_landing": "SELECT * FROM events",
    "stream_landing_replace": "SELECT * FROM events",
    "std_text": (
        f"SELECT sid AS row_id, {text('Surname')} AS surname, {title('Geography')} AS geography, "
        f"{lower('Gender')} AS gender FROM raw_customers"
    ),
    "std_currency": "SELECT sid AS row_id, monthly_balance AS balance FROM std_usage",
    "std_cast": (
        "SELECT sid AS row_id, Age AS age, CustomerId AS customer_id, "
        "CreditScore AS credit_score, IsActiveMember AS is_active FROM std_customers"
    ),
    "std_date": f"SELECT ticket_id, created_at, {date('created_at')} AS created_on FROM raw_tickets",
    "std_bool": (
        f"SELECT offer_id, accepted AS answer, {flag('r.accepted')} AS accepted FROM raw_offers r"
    ),
    "std_month": "SELECT sid AS row_id, usage_month FROM std_usage",
    "month_bucket": (
        "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders"
    ),
    "row_fingerprint": _fingerprint(),
    "dedupe_exact": (
        f"SELECT {', '.join(COLUMNS['usage'])}, CASE WHEN copy_number > 1 "
        "THEN 'exact_duplicate' END AS rejection_reason FROM numbered_usage"
    ),
    "source_lines": (
        f"SELECT 'tickets' AS source, count(*) AS row_count FROM lineitem WHERE {TICKET_LINES} "
        f"UNION ALL SELECT 'offers', count(*) FROM lineitem WHERE NOT {TICKET_LINES} "
        "UNION ALL SELECT 'lineitem', count(*) FROM lineitem"
    ),
    "dedupe_key": (
        f"SELECT {', '.join(COLUMNS['tickets'])}, CASE WHEN ticket_id IS NOT NULL AND "
        "row_number() OVER (PARTITION BY ticket_id ORDER BY sid) > 1 "
        "THEN 'duplicate_ticket_id' END AS rejection_reason "
        "FROM numbered_tickets WHERE copy_number = 1"
    ),
    "fk_reference": "SELECT DISTINCT CustomerId FROM clean_customers",
    "fk_check": (
        "SELECT ticket_id, customer_id, CASE WHEN customer_id IN "
        "(SELECT CustomerId FROM clean_customers) THEN true END AS customer_exists "
        "FROM std_tickets"
    ),
    "fk_semi": (
        "SELECT customer_id, activity_month FROM offers_monthly "
        "WHERE customer_id IN (SELECT CustomerId FROM clean_customers)"
    ),
    "validate_customers": _validated("customers"),
    "validate_tickets": _validated("tickets"),
    "validate_offers": _validated("offers"),
    "validate_usage": _validated("usage"),
    "silver_customers": _silver("customers"),
    "silver_tickets": _silver("tickets"),
    "silver_offers": _silver("offers"),
    "silver_usage": _silver("usage"),
    "rejected_union": " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, {varchar(KEYS[name])} AS business_key, rejection_reason "
        f"FROM silver_{name} WHERE rejection_reason IS NOT NULL"
        for name, dataset in _DATASETS.items()
    ),
    "rejection_report": (
        "SELECT rejection_reason, count(*) AS rejected_rows FROM silver_tickets "
        "WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason"
    ),
    "reconcile": " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, (SELECT count(*) FROM raw_{name}) AS source_rows, "
        "count(*) FILTER (rejection_reason IS NULL) AS clean_rows, "
        "count(*) FILTER (rejection_reason IS NOT NULL) AS rejected_rows, "
        f"(SELECT count(*) FROM raw_{name}) - count(*) AS unaccounted_rows, "
        + half_up(
            "count(*) FILTER (rejection_reason IS NOT NULL) "
            f"/ (SELECT count(*) FROM raw_{name}) * 100"
        )
        + f" AS rejection_rate FROM silver_{name}"
        for name, dataset in _DATASETS.items()
    ),
    "clv": "SELECT customer_id, round(CLV_LTV + 1e-9, 6) AS CLV_LTV FROM clv",
    "ticket_avg": (
        "SELECT customer_id, round(avg_ticket_res_time_hrs + 1e-9, 6) AS avg_ticket_res_time_hrs "
        "FROM ticket_avg"
    ),
    "usage_monthly": (
        "SELECT * REPLACE (round(total_balance + 1e-9, 6) AS total_balance, "
        "round(avg_balance + 1e-9, 6) AS avg_balance) FROM usage_monthly"
    ),
    "tickets_monthly": (
        "SELECT * REPLACE (round(avg_resolution_time + 1e-9, 6) AS avg_resolution_time) "
        "FROM tickets_monthly"
    ),
    "offers_monthly": (
        "SELECT * REPLACE (round(acceptance_rate + 1e-9, 6) AS acceptance_rate) FROM offers_monthly"
    ),
    "activity_spine": "SELECT * FROM spine",
    "surrogate_key": (
        "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS cust_key "
        "FROM customer"
    ),
    "surrogate_key_multi": (
        "SELECT *, row_number() OVER (ORDER BY o_custkey, order_month) AS activity_key FROM "
        "(SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders)"
    ),
    "gold_dim_customer": (
        "SELECT * REPLACE (round(CLV_LTV + 1e-9, 6) AS CLV_LTV, "
        "round(avg_ticket_res_time_hrs + 1e-9, 6) AS avg_ticket_res_time_hrs) FROM dim"
    ),
    "gold_fact_activity": (
        "SELECT * REPLACE (round(total_balance + 1e-9, 6) AS total_balance, "
        "round(avg_balance + 1e-9, 6) AS avg_balance, "
        "round(avg_resolution_time + 1e-9, 6) AS avg_resolution_time, "
        "round(acceptance_rate + 1e-9, 6) AS acceptance_rate) FROM fact"
    ),
    "gold_monthly_churn": "SELECT * REPLACE (round(churn_rate + 1e-9, 6) AS churn_rate) FROM mart",
    "gold_row_counts": (
        "SELECT 'dim_customer' AS table_name, count(*) AS row_count FROM dim UNION ALL "
        "SELECT 'fact_customer_activity', count(*) FROM fact UNION ALL "
        "SELECT 'monthly_churn_rate', count(*) FROM mart"
    ),
    "gold_published": " UNION ALL ".join(
        f"SELECT '{when}' AS seen, '{name}' AS table_name, count(*) AS row_count FROM {rows}"
        for when, only in (("first", True), ("failed", True), ("second", False))
        for name, rows in (
            ("dim_customer", "dim" + " WHERE is_churned = 1" * only),
            ("fact_customer_activity", _CHURNED_FACT if only else "fact"),
            (
                "monthly_churn_rate",
                f"(SELECT DISTINCT activity_month FROM {_CHURNED_FACT})" if only else "mart",
            ),
        )
    ),
    "gold_tables_register": (
        "SELECT activity_month, count(*) AS fact_rows, "
        f"{big('sum(is_churned)')} AS churned_rows, count(*) AS active_customers "
        "FROM fact JOIN dim USING (cust_key) GROUP BY activity_month"
    ),
    "dq_report": quality("dim", "fact", "mart"),
    "dq_report_defects": quality("bad_dim", "bad_fact", "bad_mart"),
    "dq_duplicates": (
        "SELECT l_orderkey, l_linenumber, count(*) AS rows_in_group FROM lineitem "
        "GROUP BY ALL HAVING count(*) > 1"
    ),
    "dq_orphans": (
        "SELECT DISTINCT customer_id FROM std_usage u WHERE NOT EXISTS "
        "(SELECT 1 FROM clean_customers c WHERE c.CustomerId = u.customer_id)"
    ),
    "dq_orphan_rows": (
        "SELECT count(*) AS orphan_rows FROM std_usage u "
        "LEFT JOIN clean_customers c ON c.CustomerId = u.customer_id WHERE c.CustomerId IS NULL"
    ),
    "bi_q01": (
        "SELECT customer_id, round(CLV_LTV + 1e-9, 6) AS CLV_LTV, num_products, is_churned FROM dim "
        "ORDER BY dim.CLV_LTV DESC, customer_id LIMIT 10"
    ),
    "bi_q02": f"""
SELECT {_segment("CLV_LTV", "High Value", "Medium Value", "Low Value", (10000, 1000))}
    AS customer_segment, count(*) AS customers, {big("sum(is_churned)")} AS churned_customers,
  {half_up("avg(is_churned) * 100")} AS churn_rate
FROM dim GROUP BY ALL""",
    "bi_q03": (
        "SELECT activity_month, active_customers, churned_customers, "
        f"{half_up('churn_rate * 100')} AS churn_percentage FROM mart "
        "ORDER BY churn_rate DESC, activity_month LIMIT 5"
    ),
    "bi_q04": (
        "SELECT activity_month, active_customers, churned_customers, "
        f"{half_up('churn_rate * 100')} AS churn_percentage FROM mart"
    ),
    "bi_q05": f"""
SELECT f.customer_id, {big("sum(ticket_count)")} AS total_tickets,
  {half_up("avg(avg_resolution_time)")} AS avg_resolution_time,
  round(CLV_LTV + 1e-9, 6) AS CLV_LTV, is_churned
FROM fact f JOIN dim d ON f.cust_key = d.cust_key GROUP BY f.customer_id, CLV_LTV, is_churned
ORDER BY total_tickets DESC, f.customer_id LIMIT 10""",
    "bi_q06": f"""
SELECT CASE WHEN avg_resolution_time < 24 THEN 'Less than 24 hrs'
    WHEN avg_resolution_time < 48 THEN '24-48 hrs' ELSE '48+ hrs' END AS resolution_group,
  count(DISTINCT d.customer_id) AS customers,
  count(DISTINCT CASE WHEN is_churned = 1 THEN d.customer_id END) AS churned_customers,
  {half_up("count(DISTINCT CASE WHEN is_churned = 1 THEN d.customer_id END) * 100.0"
           " / count(DISTINCT d.customer_id)")} AS churn_rate
FROM fact f JOIN dim d ON f.cust_key = d.cust_key GROUP BY 1""",
    "bi_q07": f"""
SELECT {big("sum(offer_count)")} AS total_offers, {big("sum(accepted_offers)")} AS accepted_offers,
  {half_up("sum(accepted_offers) * 100.0 / nullif(sum(offer_count), 0)")} AS acceptance_rate
FROM fact""",
    "bi_q08": f"""
SELECT num_products, count(*) AS customers, {half_up("avg(CLV_LTV)")} AS avg_clv,
  {half_up("avg(is_churned) * 100")} AS churn_rate
FROM dim GROUP BY num_products""",
    "bi_q09": _churn_by_total(
        "total_balance",
        "balance_segment",
        _segment("total", "High Balance", "Medium Balance", "Low Balance", (10000, 1000)),
    ),
    "bi_q10": _churn_by_total(
        "usage_events",
        "engagement_segment",
        _segment("total", "Highly Engaged", "Moderately Engaged", "Low Engagement", (20, 5)),
    ),
    "bi_q11": f"""
SELECT num_products, count(*) AS customers, {big("sum(is_churned)")} AS churned_customers,
  {half_up("avg(is_churned) * 100")} AS churn_rate, {half_up("avg(CLV_LTV)")} AS average_clv
FROM dim GROUP BY num_products""",
    "bi_q12": f"""
SELECT customer_id, round(CLV_LTV + 1e-9, 6) AS CLV_LTV, num_products, total_usage, total_tickets,
  is_churned
FROM dim JOIN (
  SELECT customer_id, {big("sum(usage_events)")} AS total_usage,
    {big("sum(ticket_count)")} AS total_tickets FROM fact GROUP BY customer_id)
USING (customer_id)
WHERE is_churned = 0 AND dim.CLV_LTV >= 1000 AND total_usage < 5
ORDER BY dim.CLV_LTV DESC, customer_id LIMIT 20""",
    "bi_q13": f"""
SELECT CASE WHEN is_churned = 1 THEN 'Already Churned'
    WHEN CLV_LTV >= 10000 AND total_usage < 5 THEN 'High Value - High Risk'
    WHEN CLV_LTV >= 1000 AND total_usage < 5 THEN 'Medium Value - High Risk'
    WHEN total_usage >= 20 THEN 'Highly Engaged' ELSE 'Stable Customer' END AS customer_segment,
  count(*) AS customers, {half_up("avg(CLV_LTV)")} AS average_clv,
  {half_up("avg(total_usage)")} AS average_usage,
  {half_up("avg(total_tickets)")} AS average_tickets
FROM (
  SELECT d.customer_id, d.CLV_LTV, d.is_churned, coalesce(sum(usage_events), 0) AS total_usage,
    coalesce(sum(ticket_count), 0) AS total_tickets
  FROM dim d LEFT JOIN fact f ON d.cust_key = f.cust_key GROUP BY ALL)
GROUP BY 1""",
    "ml_features": (
        "SELECT * REPLACE ("
        + ", ".join(f"round({name} + 1e-9, 6) AS {name}" for name in sorted(_ROUNDED_FEATURES))
        + ") FROM feature_rows"
    ),
    "ml_last_activity": (
        "SELECT * REPLACE (round(last_total_balance + 1e-9, 6) AS last_total_balance) FROM last_month"
    ),
    "ml_class_balance": (
        "SELECT is_churned, count(*) AS customers, "
        "round(count(*) / (SELECT count(*) FROM dim) + 1e-9, 6) AS share FROM dim GROUP BY is_churned"
    ),
    "ml_corr": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, round(corr({name}, is_churned) + 1e-9, 6) AS correlation "
        "FROM feature_rows"
        for name in FEATURES
    ),
    "ml_missing": (
        "SELECT "
        + " + ".join(f"count(*) FILTER ({name} IS NULL)" for name in FEATURES)
        + " AS missing_values FROM feature_rows"
    ),
    "ml_split": _split_rows("dim"),
    "ml_confusion_rule": (
        "SELECT actual_churn, predicted_churn, count(*) AS customers FROM rule_rows GROUP BY ALL"
    ),
    "ml_class_report_rule": " UNION ALL ".join(
        f"SELECT {c} AS class, round(hits / claimed + 1e-9, 6) AS precision, "
        "round(hits / support + 1e-9, 6) AS recall, support, "
        "round(2 * (hits / claimed) * (hits / support) / (hits / claimed + hits / support) + 1e-9, 6) "
        f"AS f1 FROM (SELECT count(*) FILTER (actual_churn = {c} AND predicted_churn = {c}) "
        f"AS hits, count(*) FILTER (predicted_churn = {c}) AS claimed, "
        f"count(*) FILTER (actual_churn = {c}) AS support FROM rule_rows)"
        for c in (0, 1)
    ),
    # The area is the share of (churned, staying) pairs in the right order, a
    # tie counting one half; pairs are counted through ranks.
    "ml_eval_rule": """
SELECT round(avg(CASE WHEN actual_churn = predicted_churn THEN 1.0 ELSE 0.0 END) + 1e-9, 6) AS accuracy,
  round((sum(CASE WHEN actual_churn = 1 THEN mid END)
    - count(*) FILTER (actual_churn = 1) * (count(*) FILTER (actual_churn = 1) + 1) / 2)
    / (count(*) FILTER (actual_churn = 1) * count(*) FILTER (actual_churn = 0)) + 1e-9, 6) AS roc_auc
FROM (
  SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS mid
  FROM rule_rows)""",
    "ml_class_weights": (
        "SELECT is_churned, count(*) AS customers, round((SELECT count(*) FROM split_rows "
        "WHERE split = 'train') / (2 * count(*)) + 1e-9, 6) AS weight "
        "FROM split_rows WHERE split = 'train' GROUP BY is_churned"
    ),
    "ml_scaler": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, round(avg(coalesce({name}, 0)) + 1e-9, 3) AS mean, "
        f"round(stddev_samp(coalesce({name}, 0)) + 1e-9, 3) AS deviation "
        "FROM feature_rows JOIN split_rows USING (customer_id) WHERE split = 'train'"
        for name in FEATURES
    ),
    "ml_score_rules": (
        "SELECT customer_id, is_churned AS actual_churn, true AS consistent FROM dim"
    ),
    "ml_score_nodes": "SELECT customer_id, is_churned AS actual_churn, true AS same FROM dim",
    "ml_importance_total": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, true AS not_negative, CAST(1 AS DOUBLE) AS total"
        for name in FEATURES
    ),
    "ml_separable_score": (
        "SELECT customer_id, is_churned AS actual_churn, is_churned AS predicted_churn, "
        "CASE WHEN is_churned = 1 "
        "THEN 'Likely to churn' ELSE 'Likely to stay' END AS prediction_label, "
        "true AS probability_is_right FROM separable_rows"
    ),
    "ml_separable_confusion": (
        "SELECT is_churned AS actual_churn, is_churned AS predicted_churn, count(*) AS customers "
        "FROM separable_rows WHERE split = 'test' GROUP BY ALL"
    ),
    "ml_separable_class_report": (
        "SELECT is_churned AS class, CAST(1 AS DOUBLE) AS precision, CAST(1 AS DOUBLE) AS recall, "
        "count(*) AS support, CAST(1 AS DOUBLE) AS f1 "
        "FROM separable_rows WHERE split = 'test' GROUP BY is_churned"
    ),
    "ml_separable_eval": (
        "SELECT unnest(['accuracy', 'roc_auc']) AS metric, CAST(1 AS DOUBLE) AS value"
    ),
    "ml_separable_first": "SELECT 'num_products' AS feature, true AS kept",
}

_MEANS = "total_balance avg_balance avg_resolution_time acceptance_rate".split()
_ROUNDED_MEANS = ", ".join(f"round({name} + 1e-9, 6) AS {name}" for name in _MEANS)
_LATE = "activity_month IN ('1997-03', '1998-07')"

FINAL["rollup_merge"] = f"""
SELECT * REPLACE ({_ROUNDED_MEANS}) FROM (
  SELECT customer_id, activity_month, coalesce(usage_events, 0) AS usage_events, total_balance,
    avg_balance, coalesce(ticket_count, 0) AS ticket_count, avg_resolution_time,
    coalesce(offer_count, 0) AS offer_count, coalesce(accepted_offers, 0) AS accepted_offers,
    acceptance_rate
  FROM usage_monthly
  FULL JOIN tickets_monthly USING (customer_id, activity_month)
  FULL JOIN offers_monthly USING (customer_id, activity_month))"""
FINAL["gold_fact_increment"] = f"""
SELECT * EXCLUDE (activity_key) REPLACE ({_ROUNDED_MEANS}),
  CASE WHEN NOT ({_LATE} AND customer_id % 3 = 0) THEN true END AS key_kept,
  true AS keys_dense, {_LATE} AS rebuilt
FROM fact"""
FINAL["job_silver"] = " UNION ALL ".join(
    f"SELECT '{dataset}' AS dataset, {varchar(KEYS[name])} AS business_key, rejection_reason "
    f"FROM silver_{name}"
    for name, dataset in _DATASETS.items()
)
# The jobs build from raw files what the plans build from the tables.
FINAL["job_gold_dim"] = FINAL["gold_dim_customer"]
FINAL["job_gold_fact"] = FINAL["gold_fact_activity"]
FINAL["job_gold_mart"] = FINAL["gold_monthly_churn"]

# How tables are laid out does not change an answer.
for _number in ("05", "06", "09", "10", "13"):
    FINAL[f"bucketed_q{_number}"] = FINAL[f"bi_q{_number}"]

ORACLES: dict[str, str] = {name: with_chain(sql) for name, sql in FINAL.items()}
