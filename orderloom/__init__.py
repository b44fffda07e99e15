"""Order analytics on Spark: bronze, silver, gold and mart tables for order lines."""
