"""Population-access analytics on Spark: hex-indexed demand, facility catchments, site selection."""
