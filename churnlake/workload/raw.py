"""Raw sources derived from the given tables.

Rows are made dirty by rules on their keys, so that the oracle can state the
same rows in SQL: mixed date layouts and cases, currency signs, blank and
unreadable cells, unknown customers, copies, and second rows of a key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.standardize import DATE_LAYOUTS
from churnlake.sources.readers import SOURCE_ID, fit_columns
from churnlake.sources.specs import CUSTOMERS, OFFERS, TICKETS, USAGE

# The date the workload is judged at; all order and ship dates lie before it.
AS_OF = "2002-01-01"

# Added to a customer id to make it unknown.
UNKNOWN = 10_000_000_000

FIRST, COPY, SECOND = 0, 1, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.to_date(F.lit(AS_OF))


def _every(key: str, step: int, at: int) -> Column:
    return F.expr(f"({key}) % {step} = {at}")


def _repeat(df: DataFrame, copied: Column, second: Column | None = None) -> DataFrame:
    """Add ``version``: 0 for the row itself, 1 for a copy, 2 for a second row."""

    def versions(*numbers: int) -> Column:
        return F.array(*[F.lit(number) for number in numbers])

    if second is None:
        present = F.when(copied, versions(FIRST, COPY)).otherwise(versions(FIRST))
    else:
        present = (
            F.when(copied & second, versions(FIRST, COPY, SECOND))
            .when(copied, versions(FIRST, COPY))
            .when(second, versions(FIRST, SECOND))
            .otherwise(versions(FIRST))
        )
    return df.withColumn("version", F.explode(present))


def _string(value: Column) -> Column:
    return value.cast("string")


def _pick(index: Column, *choices: str) -> Column:
    return F.element_at(F.array(*[F.lit(choice) for choice in choices]), index + 1)


def _money(cents: Column) -> Column:
    """-123456 to ``-$1,234.56``; below a million."""
    size = F.abs(cents)
    units = F.floor(size / 100)
    thousands = F.floor(units / 1000)
    grouped = F.when(
        thousands > 0,
        F.concat(_string(thousands), F.lit(","), F.lpad(_string(units % 1000), 3, "0")),
    ).otherwise(_string(units))
    sign = F.when(cents < 0, "-$").otherwise("$")
    return F.concat(sign, grouped, F.lit("."), F.lpad(_string(size % 100), 2, "0"))


def _date_text(value: Column, layout: Column) -> Column:
    return F.coalesce(
        *[
            F.when(layout == number, F.date_format(value, pattern))
            for number, pattern in enumerate(DATE_LAYOUTS)
        ]
    )


def _unless(value: Column, *exceptions: tuple[Column, str | None]) -> Column:
    """``value``, replaced by the text of the first exception that applies."""
    chain = None
    for condition, replacement in exceptions:
        text = F.lit(replacement).cast("string")
        chain = F.when(condition, text) if chain is None else chain.when(condition, text)
    return chain.otherwise(value)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of a few narrow columns over all tasks of a shuffle. They take little room,
    so a scan makes few partitions of them, but many parsed cells are made of each; AQE
    leaves a given number of partitions as it is."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *rows.columns)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal"
    )
    rows = _repeat(_dealt(customers), _every("c_custkey", 10, 0), _every("c_custkey", 14, 1))
    return rows.withColumn(SOURCE_ID, F.col("c_custkey") * 4 + F.col("version"))


def _customer_cells(rows: DataFrame, *others: str) -> DataFrame:
    key = F.col("c_custkey")
    copy, second = F.col("version") == COPY, F.col("version") == SECOND
    country = F.when(F.col("c_nationkey") == 24, "Italy").otherwise(
        _pick(F.col("c_nationkey") % 3, "France", "Spain", "Germany")
    )
    age = F.expr("18 + c_custkey % 73")
    shift = F.when(second, 1).otherwise(0)
    opened = F.date_add(F.to_date(F.lit("1990-01-01")), F.expr("int(c_custkey % 4000)"))
    cells = {
        "RowNumber": _string(key + 1 + F.when(second, 1_000_000_000).otherwise(0)),
        "CustomerId": _unless(
            F.when(copy, F.concat(F.lit(" "), _string(key), F.lit(" "))).otherwise(_string(key)),
            (_every("c_custkey", 97, 13), "   "),
        ),
        "Surname": _unless(
            F.when(copy, F.concat(F.lit("  "), F.col("c_name"))).otherwise(F.col("c_name")),
            (_every("c_custkey", 89, 7), " "),
        ),
        "CreditScore": _unless(
            _string(F.lit(300) + (key * 7 + shift) % 551),
            (_every("c_custkey", 61, 4), "299"),
            (_every("c_custkey", 67, 9), "n/a"),
        ),
        "Geography": F.when(key % 3 == 0, F.upper(country))
        .when(key % 3 == 1, F.lower(country))
        .otherwise(country),
        "Gender": _unless(
            F.when(key % 2 == 0, "MALE").otherwise("female"), (_every("c_custkey", 71, 5), "X")
        ),
        "Age": _unless(
            F.when(key % 11 == 0, F.concat(_string(age), F.lit(".0"))).otherwise(_string(age)),
            (_every("c_custkey", 53, 2), "17"),
            (_every("c_custkey", 59, 3), "17.9"),
        ),
        "Tenure": F.when(key % 79 == 8, _string(age)).otherwise(_string(key % 12)),
        "Balance": _money(F.round(F.col("c_acctbal") * 100).cast("long")),
        "NumOfProducts": _string(F.col("c_nationkey") % 4 + 1),
        "HasCrCard": _unless(_string(key % 2), (_every("c_custkey", 101, 11), "2")),
        "IsActiveMember": _unless(
            F.when(key % 3 == 0, "1").otherwise("0"), (_every("c_custkey", 103, 12), "x")
        ),
        "EstimatedSalary": _unless(
            F.concat(F.lit("$"), _string(key * 31 % 150_000), F.lit(".50")),
            (_every("c_custkey", 107, 6), "-1"),
        ),
        "Exited": _unless(
            F.when(F.col("c_acctbal") < 1000, "1").otherwise("0"),
            (_every("c_custkey", 109, 10), "7"),
        ),
        "tenure_months": _unless(
            _string(key % 12 * 12), (_every("c_custkey", 113, 21), "-3")
        ),
        "date_opened": _unless(
            _date_text(opened, key % 5),
            (_every("c_custkey", 83, 9), "junk"),
            (_every("c_custkey", 127, 30), "2090-01-01"),
        ),
    }
    return rows.select(*[cells[name].alias(name) for name in CUSTOMERS.columns], *others)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _repeat(
        table(spark, sf_dir, "orders"), _every("o_orderkey", 20, 0), _every("o_orderkey", 33, 1)
    )
    return rows.withColumn(SOURCE_ID, F.col("o_orderkey") * 4 + F.col("version"))


def _usage_cells(rows: DataFrame, *others: str) -> DataFrame:
    key = F.col("o_orderkey")
    copy, second = F.col("version") == COPY, F.col("version") == SECOND
    log_id = F.concat(F.lit("USG"), _string(key))
    cents = F.floor(F.col("o_totalprice") / 2) + F.when(second, 100).otherwise(0)
    ordered = F.col("o_orderdate")
    cells = {
        "usage_log_id": _unless(
            F.when(copy, F.concat(F.lit(" "), log_id)).otherwise(log_id),
            (_every("o_orderkey", 89, 17), ""),
        ),
        "customer_id": _unless(
            F.when(key % 50 == 7, _string(F.col("o_custkey") + UNKNOWN)).otherwise(
                _string(F.col("o_custkey"))
            ),
            (_every("o_orderkey", 73, 5), None),
        ),
        "usage_month": _unless(
            F.when(key % 3 == 0, F.date_format(ordered, "yyyy-MM"))
            .when(key % 3 == 1, F.date_format(ordered, "yyyy/MM"))
            .otherwise(F.date_format(ordered, "MM/yyyy")),
            (_every("o_orderkey", 101, 3), "2025-13"),
            (_every("o_orderkey", 131, 40), "2090-01"),
        ),
        "product_type": _unless(F.col("o_orderpriority"), (_every("o_orderkey", 61, 60), " ")),
        "monthly_balance": _unless(
            _money(cents.cast("long")),
            (_every("o_orderkey", 97, 20), "-$1.00"),
            (_every("o_orderkey", 139, 41), "abc"),
        ),
        "num_products": _unless(
            _string(F.col("o_custkey") % 4), (_every("o_orderkey", 149, 50), "")
        ),
    }
    return rows.select(*[cells[name].alias(name) for name in USAGE.columns], *others)


# Every line item is a ticket or an offer: returned ones and the even orders of
# those not decided yet are tickets, all others offers.
TICKET_LINES = "l_returnflag = 'R' OR (l_returnflag = 'N' AND l_orderkey % 2 = 0)"


def _lines(spark: SparkSession, sf_dir: str, tickets: bool) -> DataFrame:
    """The line items of one source, some of them twice, with their arrival id.

    Order and line number repeat, so the id also takes in part, supplier and
    ship date.
    """
    rows = _repeat(
        table(spark, sf_dir, "lineitem").where(F.expr(TICKET_LINES) == tickets),
        _every("l_orderkey + l_linenumber", 25, 0),
    )
    line = F.expr("cast(l_orderkey * 10 + l_linenumber as decimal(38, 0))")
    wide = F.lit(100_000_000_000).cast("decimal(12, 0)")
    order = (line * wide + F.col("l_partkey")).cast("decimal(38, 0)")
    source_id = (order * wide + F.col("l_suppkey") * 10 + F.col("version")).cast("decimal(32, 0)")
    day = F.datediff(F.col("l_shipdate"), F.lit("1970-01-01"))
    source_id = (source_id * F.lit(100_000).cast("decimal(6, 0)") + day).cast("decimal(38, 0)")
    return rows.withColumn(SOURCE_ID, source_id)


def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that tickets and offers have without their copies, and all line items."""
    counted = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source"), "row_count"
        )
        for name, rows in (
            ("tickets", _lines(spark, sf_dir, tickets=True).where(F.col("version") == FIRST)),
            ("offers", _lines(spark, sf_dir, tickets=False).where(F.col("version") == FIRST)),
            ("lineitem", table(spark, sf_dir, "lineitem")),
        )
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _line_id() -> Column:
    return F.concat_ws("-", _string(F.col("l_orderkey")), _string(F.col("l_linenumber")))


def _line_customer() -> Column:
    known = F.expr("l_partkey * 3 div 4")
    return _unless(
        F.when(_every("l_orderkey", 60, 9), _string(known + UNKNOWN)).otherwise(_string(known)),
        (_every("l_orderkey", 67, 3), " "),
    )


def _ticket_cells(rows: DataFrame, *others: str) -> DataFrame:
    copy = F.col("version") == COPY
    quantity = F.col("l_quantity").cast("long")
    hours = F.concat(
        _string(F.expr("cast(l_quantity as bigint) * 3 div 2")),
        F.when(quantity % 2 == 1, ".5").otherwise(".0"),
    )
    issue = _pick(
        F.col("l_linenumber") - 1,
        "App_Bug",
        "fee_dispute",
        "CARD_DECLINE",
        "fraud_alert",
        "transfer_delay",
        "login_issue",
        "app_bug",
    )
    severity = _pick((F.col("l_suppkey") % 4).cast("int"), "Low", "MEDIUM", " high ", "critical")
    cells = {
        "ticket_id": _unless(
            F.when(copy, F.concat(_line_id(), F.lit("  "))).otherwise(_line_id()),
            (_every("l_orderkey * 3 + l_suppkey", 89, 7), ""),
        ),
        "customer_id": _line_customer(),
        "issue_type": _unless(issue, (_every("l_suppkey + l_linenumber", 37, 5), "other")),
        "severity": _unless(severity, (_every("l_partkey", 53, 4), "urgent")),
        "resolution_time_hrs": _unless(
            hours,
            (_every("l_partkey", 47, 6), "720.5"),
            (_every("l_partkey", 43, 8), "soon"),
            (_every("l_partkey", 41, 0), "720"),
        ),
        "created_at": _unless(
            _date_text(F.col("l_shipdate"), F.col("l_linenumber") % 5),
            (_every("l_suppkey + l_partkey", 97, 11), "2001-02-30"),
            (_every("l_partkey", 101, 33), "2090-05-01"),
        ),
    }
    return rows.select(*[cells[name].alias(name) for name in TICKETS.columns], *others)


def _offer_cells(rows: DataFrame, *others: str) -> DataFrame:
    copy = F.col("version") == COPY
    answer = F.when(
        F.col("l_linestatus") == "F", _pick(F.col("l_linenumber") % 4, "YES", "y", "1", "True")
    ).otherwise(_pick(F.col("l_linenumber") % 4, "no", "N", "0", "false"))
    offer = _pick(
        F.col("l_linenumber") % 5,
        "Card_Upgrade",
        "fee_waiver",
        "LOAN_RATE_CUT",
        "savings_bonus",
        "cashback",
    )
    cells = {
        "offer_id": _unless(
            F.when(copy, F.concat(F.lit(" "), _line_id())).otherwise(_line_id()),
            (_every("l_orderkey * 3 + l_suppkey", 89, 7), ""),
        ),
        "customer_id": _line_customer(),
        "offer_type": _unless(offer, (_every("l_partkey", 59, 7), "freebie")),
        "accepted": _unless(answer, (_every("l_partkey", 71, 9), "maybe")),
        "date_offered": _unless(
            _date_text(F.col("l_shipdate"), F.col("l_linenumber") % 5),
            (_every("l_suppkey + l_partkey", 97, 11), "2001-02-30"),
            (_every("l_partkey", 101, 33), "2090-05-01"),
        ),
    }
    return rows.select(*[cells[name].alias(name) for name in OFFERS.columns], *others)


def _id_order() -> list[Column]:
    return [F.col(SOURCE_ID)]


def _line_order() -> list[Column]:
    """The order of the ids of line items by the numbers an id is made of, which are
    compared faster; a row that lacks one of them has no id."""
    numbers = [
        F.expr("l_orderkey * 10 + l_linenumber"),
        F.col("l_partkey"),
        F.expr("l_suppkey * 10 + version"),
        F.datediff(F.col("l_shipdate"), F.lit("1970-01-01")),
    ]
    present = reduce(Column.__and__, [number.isNotNull() for number in numbers])
    return [F.when(present, number) for number in numbers]


@dataclass(frozen=True)
class RawSource:
    """``rows`` are narrow rows of a table, copies and second rows included, with their
    arrival id; ``cells`` makes text cells of them, and ``order`` is that of the ids."""

    rows: Callable[[SparkSession, str], DataFrame]
    cells: Callable[..., DataFrame]
    order: Callable[[], list[Column]] = _id_order

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.cells(self.rows(spark, sf_dir), SOURCE_ID)


raw_customers = RawSource(_customers, _customer_cells)
raw_usage = RawSource(_orders, _usage_cells)
raw_tickets = RawSource(partial(_lines, tickets=True), _ticket_cells, _line_order)
raw_offers = RawSource(partial(_lines, tickets=False), _offer_cells, _line_order)

RAW = {
    CUSTOMERS.name: raw_customers,
    TICKETS.name: raw_tickets,
    OFFERS.name: raw_offers,
    USAGE.name: raw_usage,
}


def raw_text(spark: SparkSession, sf_dir: str, source: str, columns: list[str]) -> DataFrame:
    """The raw cells without the arrival id, as a file would hold them."""
    return fit_columns(RAW[source](spark, sf_dir), columns)
