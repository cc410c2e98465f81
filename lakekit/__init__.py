"""lakekit: lakehouse analytics as DataFrame and Structured Streaming operators on open Apache Spark."""
