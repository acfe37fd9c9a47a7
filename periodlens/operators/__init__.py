"""DataFrame operators; every column is a parameter."""
