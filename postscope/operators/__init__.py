"""DataFrame -> DataFrame steps: extract, count, rank, join, sketch."""
