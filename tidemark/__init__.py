"""tidemark: minute-grain session concurrency analytics, expressed as Spark plans."""
