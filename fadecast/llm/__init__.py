"""Operators for preparing training text: ten stand-alone Spark jobs over documents,
pages and benchmark items, and the queries that apply them to whole tables."""
