"""DataFrame-to-DataFrame operators, by subject."""
