"""Image-similarity catalogues and searches expressed as Spark jobs."""
