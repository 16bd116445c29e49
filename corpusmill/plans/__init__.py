"""plans of corpusmill."""
