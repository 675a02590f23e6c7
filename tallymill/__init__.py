"""Retail order analytics as Spark DataFrame operators."""
