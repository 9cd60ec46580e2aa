"""Column expressions; no Python UDFs in this sub-package."""
