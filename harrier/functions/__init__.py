"""Column functions: geometry, rounding and labels, all from Spark built-ins."""
