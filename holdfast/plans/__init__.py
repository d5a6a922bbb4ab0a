"""The business queries, built from sources, operators and functions."""
