"""The registered queries: fixtures over the given tables, one case per operator."""
