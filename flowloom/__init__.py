"""Network traffic analytics and training-data preparation as Spark jobs."""
