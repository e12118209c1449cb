"""Column expressions. Each takes and returns Columns, so all stay in codegen."""
