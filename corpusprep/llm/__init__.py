"""Training-data operators: one module for each, and one for the queries that apply them to whole tables."""
