"""DataFrame in, DataFrame out: cohort, discovery, silver, timeline, quality, metrics."""
