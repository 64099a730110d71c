"""Layered (bronze, silver, gold) tables from periodic Parquet drops, as plain Spark DataFrame operators."""
