"""Filters, joins, aggregates, de-duplication and the checks of the verifier."""
