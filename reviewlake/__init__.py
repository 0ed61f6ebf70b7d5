"""reviewlake: product-review text analytics expressed as Spark DataFrame jobs."""
