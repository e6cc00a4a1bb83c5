"""Registered queries on the given tables, their input views and their SQL counterparts."""
