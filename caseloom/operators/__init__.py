"""DataFrame-to-DataFrame operators: cleaning, checks, model builders, summaries."""
