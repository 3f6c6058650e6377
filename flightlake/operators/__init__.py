"""DataFrame -> DataFrame analytics operators."""
