"""Multi-label document tagging as Spark jobs."""
