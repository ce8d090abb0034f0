"""DataFrame operators: each takes DataFrames and returns a lazily planned DataFrame."""
