"""Check and benchmark workload: market views over the test tables, queries and their SQL."""
