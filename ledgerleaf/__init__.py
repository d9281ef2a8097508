"""Document analytics for multi-tenant pipelines, as PySpark DataFrame jobs."""
