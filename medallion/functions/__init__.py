"""Column-level building blocks: casts, predicates, rules."""
