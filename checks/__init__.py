"""Check workload: reference-shaped inputs derived from the test tables, queries, oracles."""
