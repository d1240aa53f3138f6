"""Text mining of message and article collections as Spark DataFrame jobs."""
