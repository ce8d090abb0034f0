"""Column functions: cleaning, predicates, text and time expressions."""
