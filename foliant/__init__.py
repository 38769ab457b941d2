"""Document-migration analytics as Spark DataFrame plans."""
