"""tickloom: market-data operators for Spark, written as DataFrame -> DataFrame functions."""
