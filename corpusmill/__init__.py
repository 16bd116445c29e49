"""corpusmill: a PySpark engine that turns crawled source files, web pages and dialogues into training data."""

__version__ = "0.1.0"
