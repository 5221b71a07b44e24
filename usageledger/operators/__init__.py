"""Table-to-table building blocks: dedup, lookup joins, merge, history, checks."""
