"""Table-in, table-out analytics and machine-learning operators for PySpark."""
