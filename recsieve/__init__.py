"""recsieve: record cleaning, matching and quality checks, plus corpus operators, on Spark DataFrames."""
