"""Document analytics on Spark: DataFrame operators for recognised pages and text corpora."""
