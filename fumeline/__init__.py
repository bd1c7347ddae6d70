"""Air-quality summaries and road-line dissolves as Spark DataFrame jobs."""
