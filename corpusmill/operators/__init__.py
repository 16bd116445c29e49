"""operators of corpusmill."""
