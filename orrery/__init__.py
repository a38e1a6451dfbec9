"""Star-schema lakehouse operators written as DataFrame, SQL and Structured Streaming jobs."""
