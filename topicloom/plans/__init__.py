"""Operators put together: the daily job and the registered queries."""
