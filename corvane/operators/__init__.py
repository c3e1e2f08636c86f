"""DataFrame-to-DataFrame jobs."""
