"""DataFrame operators: assignment, grouped aggregates, k-means, fair centers, words, batches."""
