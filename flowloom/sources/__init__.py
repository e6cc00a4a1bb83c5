"""Readers and writers: captures, session statistics and dataset files."""
