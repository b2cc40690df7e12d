"""Column functions. Everything here is a built-in expression and stays inside generated code."""
