"""Real-time warehouse operators as PySpark DataFrame and Structured Streaming functions."""
