"""Table-in, table-out operators. Each takes DataFrames and plain parameters, returns a lazy one."""
