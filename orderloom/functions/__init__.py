"""Column functions. Everything here is built-in SQL, so it stays inside whole-stage code generation."""
