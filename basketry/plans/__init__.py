"""Whole jobs: the batch pipeline and the registered queries."""
