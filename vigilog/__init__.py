"""Authentication-log forensics as Spark DataFrame jobs."""
