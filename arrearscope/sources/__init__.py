"""Readers for raw and columnar inputs, writers for results."""
