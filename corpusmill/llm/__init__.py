"""llm of corpusmill."""
