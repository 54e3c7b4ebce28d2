"""Column builders: every function here returns a Column, none is a UDF."""
