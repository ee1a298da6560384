"""Registered queries: each module holds ``QUERIES`` and ``SQL`` by key."""
