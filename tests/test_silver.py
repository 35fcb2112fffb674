import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from silver_rows import clean, reasons

from churnlake.operators import dedupe
from churnlake.operators.reconcile import (
    ReconciliationError,
    reconcile,
    rejection_report,
    require_reconciled,
)
from churnlake.operators.rules import REASON
from churnlake.sources.specs import CUSTOMERS, OFFERS, TICKETS, USAGE


CUSTOMER_REASONS = [
    ({"CustomerId": " "}, "missing_customer_id"),
    ({"CreditScore": "299", "Geography": "Italy"}, "invalid_credit_score"),
    ({"CreditScore": "851"}, "invalid_credit_score"),
    ({"Surname": ""}, "missing_surname"),
    ({"Geography": "wEST gERMANY"}, "invalid_geography"),
    ({"Gender": "X"}, "invalid_gender"),
    ({"Age": "17"}, "invalid_age"),
    ({"Age": "91"}, "invalid_age"),
    ({"Tenure": "40"}, "invalid_tenure"),
    ({"Tenure": "-1"}, "invalid_tenure"),
    ({"Balance": "-$5"}, "invalid_balance"),
    ({"NumOfProducts": "-1"}, "invalid_num_products"),
    ({"HasCrCard": "2"}, "invalid_has_cr_card"),
    ({"IsActiveMember": "x"}, "invalid_active_member"),
    ({"EstimatedSalary": "none"}, "invalid_estimated_salary"),
    ({"Exited": "7"}, "invalid_exited"),
    ({"tenure_months": "-3"}, "invalid_tenure_months"),
    ({"date_opened": "2025-07-01"}, "invalid_date_opened"),
    ({"date_opened": "1/5/2023"}, "invalid_date_opened"),
    ({"CreditScore": "300"}, None),
    ({"CreditScore": "850"}, None),
    ({"Age": "18"}, None),
    ({"Age": "90"}, None),
    ({"date_opened": "2025-06-30"}, None),
    ({"Geography": " sPAIN "}, None),
    ({"Balance": "NaN"}, None),
]
TICKET_REASONS = [
    ({"ticket_id": ""}, "missing_ticket_id"),
    ({"customer_id": ""}, "missing_customer_id"),
    ({"customer_id": "101"}, "orphan_customer_id"),
    ({"issue_type": "other"}, "invalid_issue_type"),
    ({"severity": "urgent"}, "invalid_severity"),
    ({"resolution_time_hrs": "720.5"}, "invalid_resolution_time"),
    ({"resolution_time_hrs": "-1"}, "invalid_resolution_time"),
    ({"created_at": "2026-01-01"}, "invalid_created_at"),
    ({"resolution_time_hrs": "0"}, None),
    ({"resolution_time_hrs": "720"}, None),
]
OFFER_REASONS = [
    ({"offer_id": " "}, "missing_offer_id"),
    ({"customer_id": None}, "missing_customer_id"),
    ({"offer_type": "freebie"}, "invalid_offer_type"),
    ({"accepted": "maybe"}, "invalid_accepted"),
    ({"date_offered": "junk"}, "invalid_date_offered"),
    ({"customer_id": "101"}, None),
]
USAGE_REASONS = [
    ({"usage_log_id": None}, "missing_usage_log_id"),
    ({"customer_id": None}, "missing_customer_id"),
    ({"customer_id": "101"}, "orphan_customer_id"),
    ({"usage_month": "2025-07"}, "invalid_usage_month"),
    ({"usage_month": "2025-13"}, "invalid_usage_month"),
    ({"product_type": " "}, "missing_product_type"),
    ({"monthly_balance": "-1"}, "invalid_monthly_balance"),
    ({"num_products": None}, "invalid_num_products"),
    ({"usage_month": "2025-06"}, None),
]


@pytest.mark.parametrize(
    ("spec", "cases"),
    [
        (CUSTOMERS, CUSTOMER_REASONS),
        (TICKETS, TICKET_REASONS),
        (OFFERS, OFFER_REASONS),
        (USAGE, USAGE_REASONS),
    ],
)
def test_reasons(spark, spec, cases):
    """Every case gets a key of its own; its reason shows which rule came first."""
    changes = [{spec.key: str(1000 + n), **change} for n, (change, _) in enumerate(cases)]
    silver = clean(spark, spec, changes)
    assert reasons(silver) == sorted(reason for _, reason in cases if reason)
    got = {str(row[spec.key]): row.rejection_reason for row in silver.all_rows.collect()}
    for change, (_, reason) in zip(changes, cases, strict=True):
        if change[spec.key] and change[spec.key].strip():
            assert got[change[spec.key]] == reason, change


def test_usage_id_stays_text(spark):
    row = clean(spark, USAGE, [{}]).clean.first()
    assert (row.usage_log_id, row.product_type) == ("USG553504902", "card")


def test_copies_are_found_after_standardizing(spark):
    silver = clean(spark, CUSTOMERS, [{"Geography": " France"}, {"Geography": "FRANCE"}])
    assert silver.clean.count() == 1
    assert reasons(silver) == ["exact_duplicate"]


def test_copy_of_an_invalid_row(spark):
    assert reasons(clean(spark, CUSTOMERS, [{"Age": "12"}, {"Age": "12"}])) == [
        "exact_duplicate",
        "invalid_age",
    ]


def test_first_valid_row_of_a_key_wins(spark):
    silver = clean(spark, CUSTOMERS, [{"Age": "12"}, {"RowNumber": "2"}, {"RowNumber": "3"}])
    assert [row.RowNumber for row in silver.clean.collect()] == [2]
    assert reasons(silver) == ["duplicate_customer_id", "invalid_age"]


@settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "CustomerId": st.sampled_from(["1", "2", "3", " ", "x"]),
                "Age": st.sampled_from(["12", "30", "31.0"]),
                "Geography": st.sampled_from(["FRANCE", " france", "Italy"]),
            }
        ),
        min_size=1,
        max_size=40,
    )
)
def test_every_row_is_accounted_for(spark, changes):
    silver = clean(spark, CUSTOMERS, changes)
    source = spark.createDataFrame([(n,) for n in range(len(changes))], "n int")
    row = reconcile("customers", source, silver.clean, silver.rejected).first()
    assert row.source_rows == len(changes)
    assert row.unaccounted_rows == 0
    keys = [r.CustomerId for r in silver.clean.select("CustomerId").collect()]
    assert len(keys) == len(set(keys))
    allowed = {rule.reason for rule in CUSTOMERS.rules(F.current_date())}
    assert set(reasons(silver)) <= allowed | {"exact_duplicate", "duplicate_customer_id"}


def test_reconciliation_fails_on_lost_rows(spark):
    three, one = spark.range(3), spark.range(1)
    report = reconcile("x", three, one, one)
    assert report.first().rejection_rate == 33.33
    with pytest.raises(ReconciliationError, match="1 of 3"):
        require_reconciled(report)
    empty = spark.range(0)
    assert reconcile("x", empty, empty, empty).first().rejection_rate == 0.0


def test_rejection_report_orders_by_frequency(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "rejection_reason string")
    assert [tuple(row) for row in rejection_report(df).collect()] == [("b", 2), ("a", 1)]


def many_rows(spec):
    """Copies, second rows of a key, rows without key, and a key with many rows."""
    changes = []
    for n in range(120):
        key = None if n % 11 == 0 else "7" if n % 3 == 0 else str(1000 + n % 40)
        other = {"customer_id": "101"} if n % 7 == 0 else {spec.columns[-1]: "junk"} if n % 10 == 0 else {}
        changes.append({spec.key: key, **other})
    return changes


@pytest.mark.parametrize("spec", [CUSTOMERS, TICKETS, OFFERS, USAGE], ids=lambda spec: spec.name)
def test_heavy_keys_take_the_joins_and_the_same_rows_come(spark, spec, monkeypatch):
    changes = [{k: v for k, v in row.items() if k in spec.columns} for row in many_rows(spec)]

    def rows():
        return sorted(map(str, clean(spark, spec, changes).all_rows.collect()))

    dealt = rows()
    assert len(dealt) == len(changes)
    monkeypatch.setattr(dedupe, "LIGHT_ROWS", 0)
    assert rows() == dealt


def test_a_heavy_key_is_not_dealt_to_one_task(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "LIGHT_ROWS", 100)
    rows = spark.range(8000).selectExpr("if(id % 3 = 0, null, id) AS k", "id AS o", "id % 4 AS p")
    assert dedupe.tasks_by_key(rows, "k", "o") == 1
    assert dedupe.tasks_by_key(rows, "p", "o") is None
    # Rows without key count by the other column.
    assert dedupe.tasks_by_key(rows.selectExpr("k", "1 AS o"), "k", "o") is None
    monkeypatch.setattr(dedupe, "ROWS_PER_TASK", 100)
    assert dedupe.tasks_by_key(rows, "k", "o") == 80
    dealt = dedupe.deal_by_key(rows, "k", "o", 80)
    assert dealt.rdd.getNumPartitions() == 80


def test_rows_are_shuffled_once(spark, capsys):
    """Copies and key duplicates are found where one shuffle brought the rows."""
    rows = spark.range(100).selectExpr("string(id % 30) AS k", "id % 20 AS v", "id AS _at")
    dealt = dedupe.deal_by_key(rows, "k", "v", 8)
    distinct = dedupe.collapse_copies(dealt, [dedupe.DEAL, "k", "v"], "_at")
    distinct = distinct.withColumn(REASON, F.lit(None).cast("string"))
    marked = dedupe.mark_dealt_duplicates(distinct, "k", "_at", "dup", F.col(REASON).isNull())
    joined = dedupe.mark_key_duplicates(distinct, "k", "_at", "dup", F.col(REASON).isNull())
    assert sorted(marked.select("k", "v", REASON).collect(), key=str) == sorted(
        joined.select("k", "v", REASON).collect(), key=str
    )
    marked.explain("simple")
    assert capsys.readouterr().out.count("Exchange ") == 1
