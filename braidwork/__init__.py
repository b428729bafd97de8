"""Braidwork: DataFrame operators that turn nested records and wide measurement
files into linked node and edge tables, planned by Spark."""
