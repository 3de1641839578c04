"""Column expressions. All of them stay inside Spark's code generation; there are no UDFs."""
