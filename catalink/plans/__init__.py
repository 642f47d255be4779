"""catalink.plans."""
