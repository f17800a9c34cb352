"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^ \t-\r]+", text or "")


def shingles(text: str | None) -> set[tuple[str, ...]]:
    own = words(ascii_lower(text or ""))
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def near_groups(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """Smallest reachable id of each id, over all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in rows}


def kept_lines(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """n_lines, n_dropped and the kept text of each id."""
    holders: dict[str, set[int]] = {}
    keyed = {}
    for i, text in rows:
        keyed[i] = [(line, ascii_lower(line.strip(" \t\n\x0b\x0c\r"))) for line in (text or "").split("\n")]
        for _, key in keyed[i]:
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    out = {}
    for i, lines in keyed.items():
        stays = [line for line, key in lines if len(holders.get(key, ())) < 3 or max(holders[key]) == i]
        out[i] = (len(lines), len(lines) - len(stays), "\n".join(stays))
    return out


def quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    own = words(text)
    places: dict[tuple, list[int]] = {}
    for i in range(len(own) - 4):
        places.setdefault(tuple(own[i : i + 5]), []).append(i)
    covered = {p + k for at in places.values() if len(at) > 1 for p in at for k in range(5)}
    lines = [line for line in text.split("\n") if words(line)]
    return (
        len(own),
        sum(map(len, own)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(own) < 10 or 100 * len(covered) > 20 * len(own),
    )


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + n % 2) for n, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def personal_data(text: str | None) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, p in PII for m in re.finditer(p, text or "") if _valid(k, m.group())]


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by start, then kind."""
    text = text or ""
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return [(k, a, b) for a, _, b, k in sorted(found)]
