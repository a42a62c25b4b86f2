"""rosterlens: provider-network comparison as Spark DataFrame jobs."""
