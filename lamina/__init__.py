"""Layered data pipelines as Spark DataFrame operators."""
