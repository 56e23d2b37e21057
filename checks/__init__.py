"""Every operator as a query over the given tables, and the same result in plain SQL."""
