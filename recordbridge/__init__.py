"""recordbridge: move case-management records between systems with Spark and prove nothing was lost."""
