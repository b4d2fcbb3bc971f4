"""The warehouse, its checks, its cycle, and the queries over the test tables."""
