"""Feature, encoding, model and report plans built from DataFrame operators."""
