"""Adapters that read the driver's generic tables as aviation tables, and the queries over them."""
