"""Column functions: text analysis, scalar clean-up, predicates and vectors."""
