"""wordloom: subword vocabularies, token streams and token vectors as Spark jobs."""

__version__ = "0.1.0"
