"""Composite jobs and the queries registered over the shared tables."""
