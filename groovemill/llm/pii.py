"""Personal data by patterns, and disguised personal data by an offset-preserving normalisation."""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, documents

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: Letters of other scripts that look like Latin ones, by script.
LOOKALIKES = {
    "АВЕКМНОРСТУХЅІЈ": "ABEKMHOPCTYXSIJ",
    "авекмнорстухѕіј": "abekmhopctyxsij",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ": "ABEZHIKMNOPTYX",
    "αειοκνρτυχ": "aeioknptux",
}
#: Words of digits.
DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}


def _folds() -> dict[str, str]:
    table = {a: b for x, y in LOOKALIKES.items() for a, b in zip(x, y, strict=True)}
    for c in (chr(i) for i in (*range(0xFF01, 0xFF5F), 0xFE52, 0xFE6B, *range(0x1D400, 0x1D800))):
        plain = unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and plain.isascii():
            table[c] = plain
    return table


FOLDS = _folds()
_FOLD = re.compile("[Α-χЀ-ӿ﹒﹫！-～𝐀-𝟿]")
_OPEN, _CLOSE, _BLANK = "[({<", "])}>", " \t"
_BRACKET = re.compile(r"[\[({<][ \t]*(?:(at|@)|(dot|\.))[ \t]*[\])}>]", re.A | re.I)
_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")(?![A-Za-z])"
_FIRST = re.compile(rf"(?<![A-Za-z])(?:{_WORD}|plus(?![A-Za-z])|dot(?![A-Za-z]))", re.A | re.I)
#: Digits, their words and what may stand between those of one number.
_STRETCH = re.compile(rf"(?:[0-9]++|(?<![A-Za-z])(?:{_WORD}|plus(?![A-Za-z])))(?:[0-9]++|[ \t,.+()\[\]{{}}<>-]++|(?<![A-Za-z])(?:{_WORD}|(?:dot|plus)(?![A-Za-z])))*+", re.A | re.I)
_PART = re.compile(rf"(plus[ \t,-]*(?=[0-9]|{_WORD}))|({_WORD})|([0-9]+)|([ \t]+dot[ \t]+)|([ \t,-]+)|.", re.A | re.I)
_DOT = r"(?:[ \t]++dot[ \t]++|[ \t]*+[\[({<][ \t]*+(?:dot|\.)[ \t]*+[\])}>][ \t]*+)"
_DOTS = re.compile(r"[ \t]+dot[ \t]+", re.A | re.I)
_ANY_DOT = re.compile(_DOT, re.A | re.I)
_CHAIN = re.compile(rf"[A-Za-z0-9._%+-]++(?:{_DOT}[A-Za-z0-9._%+-]++)*+(?:([ \t]++at[ \t]++)|@|[ \t]*+[\[({{<][ \t]*+(?:at|@)[ \t]*+[\])}}>][ \t]*+)?+", re.A | re.I)
_SITE = re.compile(rf"[A-Za-z0-9-]++(?:(?:\.|{_DOT})([A-Za-z0-9-]++))++", re.A | re.I)
_ARTICLE = re.compile(r"(?:the|an?) (?!dot [A-Za-z0-9-]+ dot )", re.A | re.I)
#: A spaced at before a plain domain, local parts that only an address has, and fixed values: words that announce an
#: address, and words after them that are none.
_PLAIN_AT = re.compile(r"[ \t]at[ \t]+[A-Za-z0-9-]+\.[A-Za-z]", re.A | re.I)
_NAMED = re.compile(r"[A-Za-z][A-Za-z0-9]*[._][A-Za-z0-9._]*[A-Za-z0-9]", re.A)
_CUE = re.compile(r"(?<![A-Za-z])(?:e-?mail|mail|address)(?: is| me| us| to)?[ \t]*:?[ \t]+\Z", re.A | re.I)
_NO_NAMES = frozenset(("me", "us", "him", "her", "them", "you", "it", "this", "that", "is", "to", "address", "server", "servers", "only", "here", "support"))


def emails(text: str) -> list[Span]:
    """Leftmost matches of the address pattern, found from each @ so that long runs cost their length once."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return out


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(int(x) <= 255 if len(x) < 20 else int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split("."))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind in plain text."""
    digits = _DIGIT.search(text) is not None
    return {
        "email": emails(text) if "@" in text else [],
        "ip": ips(text) if digits and "." in text else [],
        "card": cards(text) if digits else [],
        "phone": phones(text) if "+" in text else [],
    }


def _brackets(text: str) -> Iterator[tuple[int, int, str]]:
    """Bracketed at and dot, with all brackets and blanks around them."""
    last = 0
    for m in _BRACKET.finditer(text):
        start, end = m.span()
        while True:
            a, b = start, end
            while a > last and text[a - 1] in _BLANK:
                a -= 1
            while b < len(text) and text[b] in _BLANK:
                b += 1
            if not (a > last and b < len(text) and text[a - 1] in _OPEN and text[b] in _CLOSE):
                break
            start, end = a - 1, b + 1
        yield a, b, "@" if m[1] else "."
        last = b


def _addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """Spaced at and dot of addresses. A spaced at needs a last label that isn't a number and a spelled dot beside it; with
    plain dots alone the local part must have a dot or underscore within, or a word like mail before it."""
    last = 0
    for m in _CHAIN.finditer(text):
        if m.start() < last or text[m.end() - 1] in _LOCAL_CHARS:
            continue
        site = _SITE.match(text, m.end())
        if not site:
            continue
        if m[1]:
            if site[1].isdecimal() or _ARTICLE.match(text, m.end()):
                continue
            if not (_ANY_DOT.search(text, m.start(), m.start(1)) or _ANY_DOT.search(text, site.start(), site.end()) or site[1].isalpha() and len(site[1]) > 1 and _announced(text, m.start(), m.start(1))):
                continue
            yield m.start(1), m.end(1), "@"
        yield from ((d.start(), d.end(), ".") for d in _DOTS.finditer(text, m.start(), site.end()))
        last = site.end()


def _announced(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] can only be the local part of an address, by its form or by the words before it."""
    if _NAMED.fullmatch(text, start, end):
        return True
    return text[start:end].lower() not in _NO_NAMES and _CUE.search(text[max(0, start - 24) : start]) is not None


def _numbers(text: str) -> Iterator[tuple[int, int, str]]:
    """Spelled digits, plus and dot of stretches that have the digits of a phone number or the parts of an IP address;
    whether they make one is left to the patterns. Blanks, commas and hyphens between single digits go, between others
    a space is left."""
    for m in _STRETCH.finditer(text):
        if m.end() - m.start() < 9:
            continue
        parts = [(p.lastindex or 0, p.start() + m.start(), p.end() + m.start(), p[0]) for p in _PART.finditer(m[0])]
        digits = sum(len(x) if k == 3 else k == 2 for k, _, _, x in parts)
        dots = m[0].count(".") + m[0].lower().count("dot")
        if digits < 4 or digits < 9 and dots < 3:
            continue
        words = any(k == 2 for k, *_ in parts)
        single = [k == 2 or k == 3 and len(x) == 1 for k, _, _, x in parts]
        for i, (k, a, b, x) in enumerate(parts):
            if k == 1:
                yield a, b, "+"
            elif k == 2:
                yield a, b, DIGIT_WORDS[x.lower()]
            elif k in (4, 5) and 0 < i < len(parts) - 1 and parts[i - 1][0] in (2, 3) and parts[i + 1][0] in (2, 3):
                if k == 4:
                    yield a, b, "."
                elif words:
                    yield a, b, "" if single[i - 1] and single[i + 1] else " "


def rewrites(text: str) -> list[tuple[int, int, str]]:
    """Non-overlapping (start, end, plain) replacements by position: what the transducers read and what they write."""
    found: list[tuple[int, int, str]] = []
    if not text.isascii() and _FOLD.search(text):
        found += [(m.start(), m.end(), FOLDS[m[0]]) for m in _FOLD.finditer(text) if m[0] in FOLDS]
    lower = text.lower()
    brackets = [] if not any(c in text for c in _OPEN) else list(_brackets(text))
    found += brackets
    dots = "dot" in lower
    if (dots or any(x == "." for *_, x in brackets)) and ("@" in text or "at" in lower) or _PLAIN_AT.search(text):
        found += _addresses(text)
    if (dots or "plus" in lower or any(w in lower for w in DIGIT_WORDS)) and _FIRST.search(text):
        found += _numbers(text)
    out, last = [], 0
    for start, end, plain in sorted(found, key=lambda x: (x[0], -x[1])):
        if start >= last and text[start:end] != plain:
            out.append((start, end, plain))
            last = end
    return out


def normalise(text: str) -> tuple[str, list[int], list[int]]:
    """(plain, starts, ends): character i of plain comes from text[starts[i]:ends[i]]. Repeats until nothing changes,
    as a folded letter may complete a word; each round leaves fewer letters, brackets or characters to fold."""
    plain, starts, ends = text, [], []
    while edits := rewrites(plain):
        if not starts:
            starts, ends = list(range(len(text))), list(range(1, len(text) + 1))
        parts, s2, e2, last = [], [], [], 0
        for a, b, new in edits:
            parts += [plain[last:a], new]
            s2 += starts[last:a] + [starts[a]] * len(new)
            e2 += ends[last:a] + [ends[b - 1]] * len(new)
            last = b
        plain = "".join([*parts, plain[last:]])
        starts, ends = s2 + starts[last:], e2 + ends[last:]
    return plain, starts, ends


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base, all): base_spans() of the text, and those with the spans that only the normalised text shows, as source positions."""
    base = base_spans(text)
    plain, starts, ends = normalise(text)
    if plain == text:
        return base, base
    return base, {k: sorted({*base[k], *_outside(base[k], [(starts[a], ends[b - 1]) for a, b in v])}) for k, v in base_spans(plain).items()}


def _outside(plain: list[Span], more: list[Span]) -> list[Span]:
    """The spans of more that aren't within one of plain; neither list has spans that overlap, both ascend."""
    begins = [a for a, _ in plain]
    return [(a, b) for a, b in more if not (i := bisect.bisect_right(begins, a)) or plain[i - 1][1] < b]


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            found = [all_spans(t or "") for t in batch.column(1).to_pylist()]
            cols = [batch.column(0), *[pa.array([len(b[k]) for b, _ in found], pa.int64()) for k in KINDS]]
            cols += [pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]), pa.array([joined(m) for _, m in found])]
            cols.append(pa.array([sum(map(len, m.values())) - sum(map(len, b.values())) for b, m in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_disguised"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text): counts of plain spans, their digest, and all spans with the disguised ones.

    Spans are kind:start:end in code points of the source, end exclusive. Homoglyphs and full-width characters are
    folded, bracketed or spaced at/dot and spelled digits written plainly, and spans of the plain text are mapped back
    through each character's source range. A spaced at counts if a dot of the address is spelled or bracketed too, the
    domain doesn't begin with an article and its last label isn't a number; with plain dots alone if the local part has a
    dot or underscore within (john.doe at example.com) or a word like mail stands before it. Plain spans always stay, so
    one with a letter of another script may stand beside its plain part; an added span within a plain one of its kind
    isn't given. Null and empty texts have none; an empty table
    gives no rows; other columns are left out.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long"
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(_find, schema)


def op10(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))
