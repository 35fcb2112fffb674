"""Good raw rows, and helpers that clean a handful of them."""

from pyspark.sql import functions as F

from churnlake.plans.silver import clean_source, standardize
from churnlake.sources.readers import SOURCE_ID
from churnlake.sources.specs import CUSTOMERS, OFFERS, TICKETS, USAGE

AS_OF = "2025-06-30"

GOOD = {
    CUSTOMERS.name: dict(
        RowNumber="1",
        CustomerId="100",
        Surname="Smith",
        CreditScore="600",
        Geography="France",
        Gender="Male",
        Age="40",
        Tenure="5",
        Balance="$1,000.00",
        NumOfProducts="2",
        HasCrCard="1",
        IsActiveMember="0",
        EstimatedSalary="5000",
        Exited="0",
        tenure_months="60",
        date_opened="2020-01-15",
    ),
    TICKETS.name: dict(
        ticket_id="T1",
        customer_id="100",
        issue_type="app_bug",
        severity="low",
        resolution_time_hrs="10",
        created_at="2025-01-15",
    ),
    OFFERS.name: dict(
        offer_id="O1",
        customer_id="100",
        offer_type="cashback",
        accepted="yes",
        date_offered="2025-01-15",
    ),
    USAGE.name: dict(
        usage_log_id="USG553504902",
        customer_id="100",
        usage_month="2025-01",
        product_type="Card",
        monthly_balance="$250.00",
        num_products="1",
    ),
}


def clean(spark, spec, changes, customer_ids=(100,)):
    """Clean the good row of ``spec`` with each of ``changes`` applied."""
    rows = [
        (*({**GOOD[spec.name], **change}[name] for name in spec.columns), n)
        for n, change in enumerate(changes)
    ]
    schema = ", ".join(f"{name} string" for name in spec.columns) + f", {SOURCE_ID} long"
    ids = spark.createDataFrame([(n,) for n in customer_ids], "CustomerId long")
    raw = spark.createDataFrame(rows, schema)
    return clean_source(standardize(raw, spec), spec, F.to_date(F.lit(AS_OF)), ids)


def reasons(silver):
    return sorted(row.rejection_reason for row in silver.rejected.collect())
