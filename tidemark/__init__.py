"""Retail revenue, type-2 dimensions, word counts and trip/store streams as plain Spark jobs."""
