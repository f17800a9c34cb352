"""Splitting text into the chunks that merges may not cross."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two spellings of the contraction group.
SPELLED_OUT_CONTRACTIONS = "(?:'[sS]|'[tT]|'[rR][eE]|'[vV][eE]|'[mM]|'[lL][lL]|'[dD])"
INLINE_CONTRACTIONS = "(?i:'s|'t|'re|'ve|'m|'ll|'d)"

# The default pattern. It spells white space out and uses no lookaround, so that
# different regex engines agree on it.
DEFAULT_PATTERN = (
    INLINE_CONTRACTIONS
    + r"| ?\p{L}+| ?\p{N}| ?[^ \t\r\n\p{L}\p{N}]+|[ \t\r\n]+"
)


def normalize_pattern(pattern: Column) -> Column:
    """Rewrite the spelled-out contraction group to the inline spelling."""
    return F.replace(pattern, F.lit(SPELLED_OUT_CONTRACTIONS), F.lit(INLINE_CONTRACTIONS))


# How many alternatives are tried one after the other; more are split into runs by their first character.
FEW_BRANCHES = 16


def _literal(text: str) -> str:
    return "".join(c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def _alternatives(tokens: list[str], at: int) -> str:
    """A pattern for what sorted tokens hold from character ``at`` on; all are longer than that."""
    runs: list[list[str]] = []
    for token in tokens:
        if runs and runs[-1][0][at] == token[at]:
            runs[-1].append(token)
        else:
            runs.append([token])
    return _branches(runs, at)


def _branches(runs: list[list[str]], at: int) -> str:
    if len(runs) <= FEW_BRANCHES:
        return "|".join(_run(run, at) for run in runs)
    step = -(-len(runs) // FEW_BRANCHES)
    parts = [runs[n : n + step] for n in range(0, len(runs), step)]
    return "|".join(f"(?=[{_literal(p[0][0][at])}-{_literal(p[-1][0][at])}])(?:{_branches(p, at)})" for p in parts)


def _run(tokens: list[str], at: int) -> str:
    """Sorted tokens with the same character ``at``: what they share, then what follows, the longest first."""
    first, last = tokens[0], tokens[-1]
    end = at + 1
    while end < len(first) and first[end] == last[end]:
        end += 1
    shared, rest = _literal(first[at:end]), tokens[1:] if len(first) == end else tokens
    if not rest:
        return shared
    return f"{shared}(?:{_alternatives(rest, end)}){'?' if len(first) == end else ''}"


def added_token_pattern(added: Sequence[str]) -> str:
    """A pattern for the longest added token at a place.

    A tree of shared beginnings: at each place a text is compared with one path through
    it, so the time for a text hardly depends on the number of tokens. A tree is as deep
    as tokens begin one another; two hundred such steps are fine (tested).
    """
    tokens = sorted({t for t in added if t})
    return _alternatives(tokens, 0)


def cut_added(text: Column, added: Sequence[str]) -> Column:
    """A text as an array of (part, token): the text before an added token, and the token, null after the last."""
    cut = F.lit(rf"([\s\S]*?)(?:({added_token_pattern(added)})|\z)")
    parts, tokens = F.regexp_extract_all(text, cut, F.lit(1)), F.regexp_extract_all(text, cut, F.lit(2))
    return F.zip_with(parts, tokens, lambda part, token: F.struct(part.alias("part"), F.nullif(token, F.lit("")).alias("token")))


def covering(pattern: str) -> str:
    """A pattern that also takes the text between matches, each stretch as one chunk.

    The default pattern matches every character already.
    """
    if pattern == DEFAULT_PATTERN:
        return pattern
    return f"(?:{pattern})|(?:(?!{pattern})[\\s\\S])+"


def chunk_array(
    text: Column, pattern: str = DEFAULT_PATTERN, added: Sequence[str] = ()
) -> Column:
    """Chunks of a text in order.

    Added tokens are cut out first, so punctuation before one cannot swallow its
    opening bracket; what lies between them is split by ``pattern``.
    """

    def split_plain(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(covering(pattern)), F.lit(0))

    if not any(added):
        return split_plain(text)
    pieces = F.transform(
        cut_added(text, added), lambda piece: F.concat(split_plain(piece["part"]), F.array_compact(F.array(piece["token"])))
    )
    return F.flatten(pieces)
