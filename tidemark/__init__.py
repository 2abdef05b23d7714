"""tidemark: a medallion lake (bronze, silver, gold) as plain Spark jobs."""
