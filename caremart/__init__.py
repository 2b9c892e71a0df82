"""Clinical and claims lakehouse on PySpark."""
