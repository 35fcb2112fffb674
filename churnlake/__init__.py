"""churnlake: a customer-churn lakehouse written with Spark DataFrames."""
