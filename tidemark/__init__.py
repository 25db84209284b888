"""tidemark: market-data analytics and corpus preparation as PySpark jobs."""
