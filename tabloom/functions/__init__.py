"""Column functions: everything here returns a Column built from Spark functions."""
