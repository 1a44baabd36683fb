"""fieldlens: land and crop analytics as PySpark DataFrame jobs."""
