"""Column helpers: one built-in Spark expression each, no UDFs."""
