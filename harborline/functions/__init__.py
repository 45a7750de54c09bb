"""Column functions.  All native unless their docstring says otherwise."""
