"""Product recommendations from explicit ratings, as Spark jobs."""
