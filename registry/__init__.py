"""The registered queries: the operators applied to the given tables, and the same results in SQL."""
