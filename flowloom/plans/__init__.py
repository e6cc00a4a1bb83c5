"""Shared plan shapes (ranks, staged tables, dimension joins) and the end-to-end jobs."""
