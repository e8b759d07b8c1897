"""Trip-duration analytics on Spark: ETL, features, training, batch and stream scoring."""
