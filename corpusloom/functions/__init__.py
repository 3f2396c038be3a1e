"""Column expressions and the few Arrow functions that Spark has no built-in for."""
