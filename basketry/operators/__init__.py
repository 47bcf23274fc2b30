"""DataFrame-to-DataFrame operators: cleaning, features, quality, ranking."""
