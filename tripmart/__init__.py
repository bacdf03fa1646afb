"""Trip analytics on Spark: raw trip records in, cleaned tables, summaries and reports out."""
