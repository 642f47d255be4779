"""catalink.operators."""
