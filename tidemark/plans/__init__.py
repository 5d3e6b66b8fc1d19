"""Whole jobs (the load), the table layout, fixture views and the registered queries."""
