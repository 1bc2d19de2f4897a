"""Point-in-time data processing as Spark DataFrame plans."""
