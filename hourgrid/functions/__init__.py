"""Column expressions: no joins, no shuffles, no Python UDFs."""
