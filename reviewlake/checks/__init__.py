"""Registered queries: every operator over the test tables, each with its SQL twin."""
