"""Trip warehouse and reporting jobs on PySpark."""
