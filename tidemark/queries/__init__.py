"""Registered queries: each applies an operator to the test tables, with its SQL twin."""
