"""Column expressions: every function here takes columns and returns a column, JVM-side."""
