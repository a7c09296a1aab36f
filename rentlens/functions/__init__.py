"""Column functions. Each takes and returns Columns and stays inside the JVM."""
