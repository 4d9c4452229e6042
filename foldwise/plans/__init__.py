"""Registered queries: each module pairs Spark queries with independent SQL for the same result."""
