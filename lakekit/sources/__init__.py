"""Reading, loading, writing and generating data."""
