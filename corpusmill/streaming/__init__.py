"""streaming of corpusmill."""
