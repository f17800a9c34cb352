"""Reading corpora, vocabularies and replies; writing ids and request files."""
