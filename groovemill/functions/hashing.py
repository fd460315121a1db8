"""Hash identities as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import JAVA_SPACE, unicode_trim

#: The owner's name with which the domains of all digests begin. Digests of an existing store come out equal when its
#: owner's name is passed instead.
OWNER = "catalog"
#: The domains after the owner's name, and the names of the relations in each.
DOMAINS = {"release": "release-relation-{}/v1", "other": "non-release-relation-{}/v1"}
RELEASE_RELATIONS = ("credited_artist", "format", "identifier", "image", "track", "video", "work")
OTHER_RELATIONS = ("artist_name_variation", "artist_url", "label_url", "master_video")


def domain(relation: str, what: str, owner: str = OWNER) -> str:
    if relation not in RELEASE_RELATIONS + OTHER_RELATIONS:
        raise ValueError(f"no such relation: {relation}")
    return f"{owner}/{DOMAINS['release' if relation in RELEASE_RELATIONS else 'other'].format(what)}"


def java_hash(c: Column) -> Column:
    """Java's String.hashCode(): 31-fold sums over UTF-16 units, wrapped to 32 bits, signed."""
    # the units are cut once: a place in a long string is found by counting from its beginning
    units = F.regexp_extract_all(F.hex(F.encode(c, "UTF-16BE")), F.lit("(....)"), F.lit(1))
    step = lambda acc, u: F.pmod(acc * 31 + F.conv(u, 16, 10).cast("long"), F.lit(1 << 32))
    return F.aggregate(units, F.lit(0).cast("long"), step, signed32)


def signed32(c: Column) -> Column:
    return F.when(c >= 1 << 31, c - (1 << 32)).otherwise(c).cast("int")


def joined_hash(*parts: Column) -> Column:
    """java_hash() of the parts that aren't blank, one after another."""
    return java_hash(F.concat(*[F.when(p.rlike(f"[^{JAVA_SPACE}]"), p).otherwise("") for p in parts]))


def format_hash(name: Column, description: Column, quantity: Column, text: Column) -> Column:
    """java_hash() of four fields with U+0000 between them, U+0001 standing for null."""
    parts = [F.coalesce(c, F.lit("\x01")) for c in (name, description, quantity, text)]
    return java_hash(F.concat_ws("\x00", *parts))


def _int32(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n), 8, "0"))


def digest(relation: str, *fields: Column, owner: str = OWNER) -> Column:
    """SHA-256 over the relation's domain and name and its trimmed fields, each framed by a mark and its length."""
    head = F.lit(bytearray(f"{domain(relation, 'identity', owner)}\x00{relation}\x00".encode()))
    framed = []
    for c in map(unicode_trim, fields):
        raw = F.encode(c, "UTF-8")
        framed.append(F.when(c.isNull(), F.unhex(F.lit("00"))).otherwise(F.concat(F.unhex(F.lit("01")), _int32(F.octet_length(raw)), raw)))
    return F.unhex(F.sha2(F.concat(head, *framed), 256))


def slot(relation: str, digest_: Column, attempt: Column, owner: str = OWNER) -> Column:
    """The signed 32-bit slot that a digest asks for at an attempt."""
    head = F.lit(bytearray(slot_head(relation, owner)))
    code = F.sha2(F.concat(head, digest_, _int32(attempt)), 256)
    return signed32(F.conv(F.substring(code, 1, 8), 16, 10).cast("long"))


def slot_head(relation: str, owner: str = OWNER) -> bytes:
    return f"{domain(relation, 'slot', owner)}\x00{relation}\x00".encode()


def slot_of(relation: str, digest_: bytes, attempt: int, owner: str = OWNER) -> int:
    """slot() of plain values."""
    code = hashlib.sha256(slot_head(relation, owner) + digest_ + attempt.to_bytes(4, "big")).digest()
    return int.from_bytes(code[:4], "big", signed=True)
