"""Column expressions: cleaning, grades and dates. No Python UDF is used anywhere."""
