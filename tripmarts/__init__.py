"""Trip records in, KPI marts and analytical summaries out, as plain Spark jobs."""

__version__ = "0.1.0"
