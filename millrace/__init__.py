"""millrace: table analytics, data preparation and review reports as Spark jobs."""
