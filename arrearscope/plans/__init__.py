"""Operators put together: the whole flow and the registered queries."""
