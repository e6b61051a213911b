"""Call-record analytics and distributed model scoring on Spark DataFrames."""
