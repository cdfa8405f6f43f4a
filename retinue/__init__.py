"""Daily user and search analytics expressed as Spark DataFrame plans."""
