"""The composed product: dimensions, facts, serving table, checks, queries, profiles, build."""
