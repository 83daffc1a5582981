"""Bronze -> Silver -> Gold table operators for PySpark."""
