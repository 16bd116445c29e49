"""functions of corpusmill."""
