"""Analytics of public civic data, and of text corpora, on Spark."""
