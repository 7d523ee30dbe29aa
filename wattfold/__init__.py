"""Metering and billing jobs on Spark: readings in, star schema and bills out."""
