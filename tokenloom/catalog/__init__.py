"""Every query of this package by name, with the SQL that checks it."""

from tokenloom.catalog import encoding, messages, models, vocabularies
from tokenloom.catalog.base import Entry

ENTRIES: dict[str, Entry] = {**encoding.ENTRIES, **vocabularies.ENTRIES, **messages.ENTRIES, **models.ENTRIES}
