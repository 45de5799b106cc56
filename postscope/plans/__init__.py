"""Composite questions, data-quality profiles, run events and the query registry."""
