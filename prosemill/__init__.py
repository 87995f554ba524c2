"""Labelled-text preparation as Spark DataFrame operators."""
