"""Column expressions shared by the operators; every one is built in, none is a Python UDF."""
