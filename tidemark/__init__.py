"""Incremental, schema-aligned table loading as Spark DataFrame operators."""
