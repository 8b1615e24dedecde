"""Facility demand analytics as Spark DataFrame operators."""
