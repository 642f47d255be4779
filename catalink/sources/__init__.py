"""catalink.sources."""
