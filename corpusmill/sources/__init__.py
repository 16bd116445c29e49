"""sources of corpusmill."""
