"""Column helpers: blank-aware arithmetic, coercion and calendar expressions."""
