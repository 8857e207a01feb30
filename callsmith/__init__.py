"""callsmith: turn tables of free-text requests into typed function calls on Spark."""
__version__ = "0.1.0"
