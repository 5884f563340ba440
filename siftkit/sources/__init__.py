"""Table readers and writers, and adapter tables over the test data."""
