"""Column expressions; everything here is built-in Spark SQL except Unicode decomposition."""
