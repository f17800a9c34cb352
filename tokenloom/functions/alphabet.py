"""The printable alphabet byte-level vocabularies write their tokens in.

Bytes 33-126, 161-172 and 174-255 stand for themselves; the other 68 bytes are
numbered upward from code point 256 in byte order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The byte ranges that are their own code point.
SELF_RANGES = ((33, 126), (161, 172), (174, 255))

_SELF = {b for lo, hi in SELF_RANGES for b in range(lo, hi + 1)}
_SHIFTED = [b for b in range(256) if b not in _SELF]
_CHARS = "".join(chr(b) for b in sorted(_SELF)) + "".join(chr(256 + n) for n in range(len(_SHIFTED)))
# The bytes of those characters, moved up by 256: ``translate`` deletes a
# character whose replacement is code point 0.
_RAISED = "".join(chr(256 + b) for b in [*sorted(_SELF), *_SHIFTED])


def byte_alphabet(spark: SparkSession) -> DataFrame:
    """The alphabet as 256 rows of (code_point, byte), from the rule above."""
    byte = F.col("id").cast("int")
    is_self = F.lit(False)
    for lo, hi in SELF_RANGES:
        is_self = is_self | byte.between(lo, hi)
    shifted_before = (
        F.when(byte <= 32, byte)
        .when(byte <= 160, byte - 94)  # the 94 self-coded bytes 33-126 lie below
        .otherwise(F.lit(67))  # only byte 173 remains
    )
    return spark.range(256).select(
        F.when(is_self, byte).otherwise(256 + shifted_before).cast("int").alias("code_point"),
        byte.alias("byte"),
    )


def char_to_byte(char: Column) -> Column:
    """The byte an alphabet character stands for; null for any other text."""
    point = F.ascii(F.translate(char, _CHARS, _RAISED)) - 256
    return F.when(spelled_in_alphabet(char) & (F.char_length(char) == 1), point)


def spelled_in_alphabet(token: Column) -> Column:
    """True when every character of a non-empty token belongs to the alphabet."""
    return (token != "") & (F.translate(token, _CHARS, "") == "")


def token_hex(token: Column, literal: Column | None = None) -> Column:
    """Raw bytes of a token, as upper-case hex.

    A token spelled in the alphabet is turned back into bytes. Special tokens
    (``literal`` true) and tokens with characters outside the alphabet keep
    the UTF-8 bytes of their own text.
    """
    transcode = spelled_in_alphabet(token)
    if literal is not None:
        transcode = transcode & ~literal
    # Every raised character is 01xx in UTF-16, with xx the byte.
    raised = F.hex(F.encode(F.translate(token, _CHARS, _RAISED), "UTF-16BE"))
    return F.when(transcode, F.regexp_replace(raised, "01(..)", "$1")).otherwise(
        F.hex(F.encode(token, "UTF-8"))
    )


def byte_chars(text: Column) -> Column:
    """UTF-8 bytes of a text as a string with one character (0-255) per byte."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def hex_chars(hex_text: Column) -> Column:
    """Bytes given as hex, as a string with one character (0-255) per byte."""
    return F.decode(F.unhex(hex_text), "ISO-8859-1")
