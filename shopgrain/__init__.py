"""Product-catalog analytics on Spark: extract, clean, enrich, summarise, publish and keep current."""
