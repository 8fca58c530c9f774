"""Operators on training text: documents, pages and conversations as Spark tables."""
