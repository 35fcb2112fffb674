import pytest
from check_oracles import compare, connect

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
CORPUS = set(contract.CORPUS_QUERIES)
MODEL = {
    name for name in contract.queries() if name not in contract.oracle_sql() and name not in CORPUS
}


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_only_model_output_lacks_an_oracle():
    assert MODEL == {
        "ml_train",
        "ml_importance",
        "ml_score",
        "ml_eval",
        "ml_compare",
        "ml_confusion",
        "ml_class_report",
    }
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "customer_segment",
        "customers",
        "churned_customers",
        "churn_rate",
    ]


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - CORPUS))
def test_query_agrees_with_sql(spark, database, name):
    problem, rows, _ = compare(spark, database, SF_DIR, name)
    assert problem == ""


def test_no_python_functions_in_the_plans(spark):
    for name in ("silver_tickets", "gold_fact_activity", "bi_q13", "ml_features"):
        plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert "PythonUDF" not in plan
        assert "EvalPython" not in plan
