"""ratingloom: feature, sampling, ranking and drift jobs over a ratings table, as Spark DataFrames."""
