"""Service-request analytics on Spark: land, clean, check, model and query a case feed."""
