"""pricetrail: price history from dated price lists, as Spark DataFrame jobs."""
