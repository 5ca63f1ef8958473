"""Composite queries: staging views, marts and whole jobs."""
