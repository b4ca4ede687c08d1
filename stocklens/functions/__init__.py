"""Column-level helpers: text keys, numbers and dates. All are built-in expressions."""
