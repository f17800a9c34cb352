"""Personal data in texts: base kinds by rule, and spans that a conditional random field adds.

The base spans are those of four fixed patterns with their checks, found left to right
without overlap per kind. Each finder reads a text once: it starts only where a match
can start, so long runs of one character cost no more than their length.

The field (``crf``) labels the words of a line by their shapes and neighbours. It is
trained from the small labelled table ``LABELLED``. A line without a digit or @ holds
none of its kinds and is not decoded. Its spans are added where no base span lies.

Spans are code points from the start of a text, end exclusive.

Nulls and odd input: a null or empty text has no spans. Repeated rows give repeated
results, null ids stay null, and an empty table gives an empty one. Other columns play
no part, or are kept by the redaction whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import crf
from tokenloom.llm.arrow import Texts, map_texts, quoted, unused
from tokenloom.llm.words import Words

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "id")

Span = tuple[str, int, int]

# The base patterns. Possessive repeats and the look-behinds change no match;
# they only keep a search from starting again inside a run that has failed.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the run of characters before it, which reaches back no further than the last match or @."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        low = found.end() if found else at + 1
        at = text.find("@", low)


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _small(number: str) -> bool:
    """Is it at most 255? Leading zeros do not count."""
    number = number.lstrip("0")
    return len(number) < 3 or (len(number) == 3 and number <= "255")


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds, by kind as listed, then start."""
    found: list[Span] = []
    if not _SEED.search(text):
        return found
    found += [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


# The labelled table: lines with [kind:words] around personal data. All of it is invented.
LABELLED = """
Call me at [phone:555-0132] tomorrow
Please phone [phone:(415) 555-0117] before noon
Tel [phone:020 7946 0018] or fax [phone:020 7946 0101]
Telefon [phone:030 901820] und Fax [phone:030 901821]
Mobile: [phone:07700 900123] ask for the manager
Tél. [phone:01 99 00 12 34] du lundi au vendredi
Teléfono [phone:91 555 01 22] de la oficina
phone number is [phone:212-555-0199] and it is new
Contact [phone:(212) 555 0143] for details
tel: [phone:+44 20 7946 0958] office
call [phone:+1 (415) 555-2671] now
you can reach us under [phone:0171 5550100] at any time
write to [email:jane.doe@example.com] today
Email [email:info@firma.example.de] oder Telefon [phone:040 555012]
mail [email:anna_b@localhost] about the job
contact [email:someone@intranet] on Monday
my address is [email:x.y-z@mail.example.org] as before
correo [email:lola22@correo.example.es] y nada
Server [ip:10.0.0.1] is down and [ip:192.168.1.44] too
ping [ip:172.16.254.1] from here
connect to [ip:8.8.4.4] port 53
card [card:4111 1111 1111 1111] expires 12/27
paid with card [card:5500-0000-0000-0004] in May
Karte [card:3782 822463 10005] ist gesperrt
card number [card:378282246310005] was stolen
Kreditkarte Nr. [card:6011000990139424] gültig
SSN [id:078-05-1120] on file
ssn: [id:219-09-9999] was given
social security number [id:457-55-5462] is listed
passport [id:C01X00T47] was lost
passport number [id:K2201399X] expired
IBAN [id:DE89370400440532013000] bank
iban [id:GB82 WEST 1234 5698 7654 32] please
NIF [id:12345678Z] del cliente
Steuernummer [id:21/815/08150] liegt vor
his id number is [id:AB123456C] as stated
In 2019 there were 1,204 entries in 37 books
version 3.11.2 came out on 2023-11-05 with 42 fixes
page 42 of 310 in volume 7
it costs $1,299.00 or 1.199,00 EUR today
about 12000 people lived there in 1850
the number 1234567890123456 means nothing here
token = "f33e61083db5dbdf4bd2369d2f80176e57f7"
password: hunter2hunter2 and key 9f86d081884c7d65
TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! WORDS!! AND!! MORE!!
the key 5E884898DA28047151D0E56F8DC6292773603D0D is a hash
sha 2c26b46b68ffc68ff99b453c1d30413413422d706483bfa0f98a5e886266e7ae ok
see section 4.2.1 and table 3.10
on 05/11/2023 at 14:30 they met for 90 minutes
the 3rd of May and the 21st of June
ISBN 978-3-16-148410-0 is a book
order 20231105-0042 was shipped on 5 May
room 101 on floor 12 of block 7
scores were 3-1 and 2-2 in 1998
follow @someone and @other_one for news
chapter 12 verse 7 line 3
call it a day at 5 or 6
this number 17 is a prime and 18 is not
items 1 2 3 4 5 6 7 8 9 10
lat 52.5200 lon 13.4050 here
from 10 to 20 and from 30 to 40 degrees
""".strip().split("\n")

_MARKED = re.compile(r"\[(\w+):([^\]]*)\]")


def labelled_lines(marked: Sequence[str]) -> tuple[list[str], list[list[int]]]:
    """Lines without their marks, and the label of each word (0: none, then ``KINDS``)."""
    lines, tags = [], []
    for line in marked:
        words, own = [], []
        at = 0
        for m in [*_MARKED.finditer(line), None]:
            plain = line[at : m.start() if m else len(line)].split()
            words += plain
            own += [0] * len(plain)
            if m:
                inside = m.group(2).split()
                words += inside
                own += [1 + KINDS.index(m.group(1))] * len(inside)
                at = m.end()
        lines.append(" ".join(words))
        tags.append(own)
    return lines, tags


def trained(marked: Sequence[str] = LABELLED) -> crf.Model:
    """A field fitted to labelled lines. Words beside personal data are its keywords."""
    lines, tags = labelled_lines(marked)
    keywords = {w.strip(".,:;").lower() for line in lines for w in line.split() if w.strip(".,:;").isalpha()}
    return crf.train(lines, tags, ("", *KINDS), sorted(keywords))


# What a span must hold at least to be one of its kind: (digits, characters).
LEAST = {"email": (0, 6), "ip": (4, 7), "card": (13, 13), "phone": (6, 7), "id": (5, 7)}
_TRIM = ".,;:!?\"'"


def added_spans(texts: Sequence[str], model: crf.Model) -> list[list[Span]]:
    """Spans that the field finds in each text."""
    out: list[list[Span]] = [[] for _ in texts]
    lines: list[tuple[int, int, str]] = []
    for n, text in enumerate(texts):
        if _SEED.search(text):
            start = 0
            for line in text.split("\n"):
                if _SEED.search(line):
                    lines.append((n, start, line))
                start += len(line) + 1
    if not lines:
        return out
    column = Texts(pa.array([line for _, _, line in lines], pa.large_string()))
    words = Words(column)
    labels = crf.decode(model, column, words)
    for k in np.unique(np.repeat(np.arange(len(lines)), words.counts)[labels > 0]):
        n, start, line = lines[k]
        own = labels[words.bounds[k] : words.bounds[k + 1]]
        spots = [m.span() for m in re.finditer(r"[^ \t-\r]+", line)]
        first = 0
        while first < len(own):
            last = first + 1
            while last < len(own) and own[last] == own[first]:
                last += 1
            if own[first]:
                span = _trimmed(line, spots[first][0], spots[last - 1][1], KINDS[own[first] - 1])
                if span:
                    out[n].append((span[0], start + span[1], start + span[2]))
            first = last
    return out


def _trimmed(line: str, a: int, b: int, kind: str) -> Span | None:
    while a < b and line[a] in _TRIM:
        a += 1
    while a < b and line[b - 1] in _TRIM:
        b -= 1
    digits, size = LEAST[kind]
    value = line[a:b]
    fits = sum(c.isdigit() for c in value) >= digits and b - a >= size and (kind != "email" or "@" in value)
    return (kind, a, b) if fits else None


def all_spans(texts: Sequence[str], model: crf.Model) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans of each text, and all spans: by kind as listed, then start."""
    base = [base_spans(t) for t in texts]
    both = []
    for own, more in zip(base, added_spans(texts, model), strict=True):
        taken = [(a, b) for _, a, b in own]
        free = [s for s in more if not any(s[1] < b and a < s[2] for a, b in taken)]
        both.append(sorted([*own, *free], key=lambda s: (KINDS.index(s[0]), s[1])))
    return base, both


@lru_cache(maxsize=1)
def default_model() -> crf.Model:
    return trained()


def spelt(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_personal_data(docs: DataFrame, keep: Sequence[str], text: str = "text", model: crf.Model | None = None) -> DataFrame:
    """Columns ``keep``, counts and a digest of the base spans, and all spans, of every row."""
    field = model or default_model()

    def run(part):
        base, both = all_spans([t or "" for t in part.column(text).to_pylist()], field)
        counts = [pa.array([sum(s[0] == k for s in own) for own in base], pa.int64()) for k in BASE]
        digests = pa.array([hashlib.sha256(spelt(own).encode()).hexdigest() for own in base], pa.string())
        return [*counts, digests, pa.array([spelt(own) for own in both], pa.string())]

    return map_texts(docs, text, run, SCHEMA, keep=keep)


def redacted(text: str, spans: Sequence[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    parts, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text", model: crf.Model | None = None) -> DataFrame:
    """The rows with personal data in their text replaced; null texts stay null."""
    field = model or default_model()

    def run(part):
        texts = part.column(text).to_pylist()
        _, both = all_spans([t or "" for t in texts], field)
        clean = [t if t is None else redacted(t, own) for t, own in zip(texts, both, strict=True)]
        return [pa.array(clean, pa.string())]

    name = unused(docs.columns, "clean")
    made = map_texts(docs, text, run, f"{name} string", keep=docs.columns)
    return made.select(*(quoted(name).alias(c) if c == text else quoted(c) for c in docs.columns))


def personal_data_in_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The query: personal data in every document."""
    return find_personal_data(spark.read.parquet(f"{folder}/documents.parquet"), ["doc_id"])


def redact_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pipeline's stage: every document, redacted, with its new length."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*(quoted(c) for c in docs.columns))
