"""Token ids as characters.

While a chunk is being encoded its token sequence is a string with exactly one
character per token. Merging two neighbours is then a literal ``replace`` of two
characters by one, the token count is ``char_length``, and no replace can match
across the edge of a token. The coding skips code point 0 and the surrogates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode's surrogate block and its last code point.
_SURROGATES_START = 0xD800
_SURROGATES_SIZE = 0x800
_LAST_CODE_POINT = 0x10FFFF

MAX_ID = _LAST_CODE_POINT - _SURROGATES_SIZE - 1


def id_char(token_id: int) -> str:
    """The character of one id, for literals."""
    if not 0 <= token_id <= MAX_ID:
        raise ValueError(f"token id {token_id} is outside 0..{MAX_ID}")
    point = token_id + 1
    return chr(point if point < _SURROGATES_START else point + _SURROGATES_SIZE)


def char_of_id(token_id: Column) -> Column:
    point = token_id.cast("int") + 1
    point = F.when(point < _SURROGATES_START, point).otherwise(point + _SURROGATES_SIZE)
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def id_of_char(char: Column) -> Column:
    point = F.ascii(char)
    return F.when(point < _SURROGATES_START, point - 1).otherwise(point - 1 - _SURROGATES_SIZE)


def ids_of_state(state: Column) -> Column:
    """The ids of a state string, as array<int>."""
    chars = F.when(state != "", F.split(state, "")).otherwise(F.array().cast("array<string>"))
    return F.transform(chars, id_of_char)
