"""Column-level building blocks: types, scalar functions, predicates, formulas."""
