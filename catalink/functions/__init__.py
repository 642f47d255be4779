"""catalink.functions."""
