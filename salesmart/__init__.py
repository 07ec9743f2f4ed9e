"""Sales-warehouse analytics expressed as Spark DataFrame plans."""
