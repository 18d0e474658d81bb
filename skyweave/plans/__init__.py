"""Marts, quality suites and the SQL surface."""
