"""Column-level building blocks: they take and return Spark columns or names."""
