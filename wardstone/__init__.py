"""Content-security analytics over tables and event logs, on Spark."""
