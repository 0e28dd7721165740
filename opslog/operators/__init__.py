"""DataFrame -> DataFrame steps. None of them starts a Spark job by itself."""
