"""Column expressions shared by the operators. All of them are built-in Spark SQL."""
