"""Layered commerce warehouse operators and analytics on PySpark."""
