"""Training-data operators for very large corpora; nothing else in the library imports this subpackage."""
