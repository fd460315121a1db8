"""String, number and array functions as column expressions: no Python runs per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points with the Unicode property White_Space.
WHITE_SPACE = r"\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: What Java's isWhitespace() accepts, which leaves out the no-break spaces.
JAVA_SPACE = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}"
#: Entity kinds by precedence, and the order in which they are processed.
KINDS = ("artist", "release", "master", "label")
ENTITIES = ("artist", "label", "master", "release")
#: Units of displayed sizes.
UNITS = {"B": 1, "KB": 1 << 10, "MB": 1 << 20, "GB": 1 << 30, "TB": 1 << 40}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once a row however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unicode_trim(c: Column) -> Column:
    """Strips Unicode white space at both ends; an empty result is null."""
    return F.nullif(F.regexp_replace(c, f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", ""), F.lit(""))


def legacy_trim(c: Column) -> Column:
    """Strips everything up to U+0020 at both ends; null if nothing but Java white space is left."""
    out = F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return F.when(~out.rlike(f"^[{JAVA_SPACE}]*$"), out)


def clean_array(c: Column, trim: Callable[[Column], Column] = unicode_trim) -> Column:
    """Trims the elements and drops null ones; an array without any left is null."""
    out = F.filter(F.transform(c, trim), lambda x: x.isNotNull())
    return F.when(F.size(out) > 0, out)


def clean_distinct(c: Column, trim: Callable[[Column], Column] = unicode_trim) -> Column:
    """clean_array() with each value once, in order of first occurrence."""
    return F.array_distinct(clean_array(c, trim))


def any_text(*c: Column) -> Column:
    """Whether any of the columns isn't null."""
    return F.coalesce(*[x.cast("string") for x in c]).isNotNull()


def has_format_identity(name: Column, text: Column, descriptions: Column) -> Column:
    """Whether a format can be told by its name, its text or its descriptions."""
    return any_text(name, text) | (F.coalesce(F.size(descriptions), F.lit(0)) > 0)


def reduced_description(descriptions: Column) -> Column:
    """[d:x] for each description, joined by commas; null if there is none."""
    return F.array_join(F.transform(clean_array(descriptions), lambda d: F.concat(F.lit("[d:"), d, F.lit("]"))), ",")


def canonical_quantity(c: Column, strict: bool = True) -> Column:
    """Digits without leading zeros, one zero kept. Null if blank; other text is an error, or null if not strict."""
    q = unicode_trim(c)
    other = F.raise_error(F.concat(F.lit("not a quantity: "), q)) if strict else F.lit(None)
    return F.when(q.rlike("^[0-9]+$"), F.regexp_replace(q, "^0+(?=.)", "")).when(q.isNotNull(), other)


def integer_quantity(canonical: Column) -> Column:
    """The quantity as int if it fits into one."""
    return canonical.try_cast("int")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def classify(path: Column) -> Column:
    """The entity of a dump's path; null if it names none."""
    low = F.lower(path)
    out = F.when(low.contains("artists"), "artist")
    for kind in KINDS[1:]:
        out = out.when(low.contains(f"{kind}s"), kind)
    return out


def display_size(value: Column, unit: Column) -> Column:
    """Bytes of a displayed size like 1.5 MB, half up; null for an unknown unit or number."""
    factor = F.element_at(F.create_map(*[F.lit(x) for p in UNITS.items() for x in p]), F.upper(unit))
    return F.round(value.try_cast("decimal(18,6)") * factor.cast("decimal(14,0)"), 0).cast("long")


def chunk_count(items: Column, size: int | Column) -> Column:
    """Chunks of `size` that hold so many items; none for none."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.when(items == 0, F.lit(0)).otherwise(F.floor((items - 1) / size) + 1).cast("long")


def positive_int(text: str) -> int:
    """A strictly positive 32-bit integer in plain digits."""
    if not text.isascii() or not text.isdigit() or not 0 < int(text) < 1 << 31:
        raise ValueError(f"not a positive integer: {text}")
    return int(text)


def schema_name(text: str) -> str:
    """A plain lower-case SQL name of at most 63 characters."""
    ok = 0 < len(text) <= 63 and text.isascii() and (text[0].isalpha() or text[0] == "_") and all(c.isalnum() or c == "_" for c in text)
    if not ok or text != text.lower():
        raise ValueError(f"not a schema name: {text}")
    return text
