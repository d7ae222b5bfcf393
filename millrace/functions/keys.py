"""Deterministic keys: every id and every draw is a pure function of its inputs, so a rerun gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_text

US = "\u001f"


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def joined(*parts) -> Column:
    """The parts as text with U+001F between them."""
    return F.concat_ws(US, *[_col(p).cast("string") for p in parts])


def digest_u32(text: Column) -> Column:
    """The first four bytes of SHA-256 as an unsigned number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def stable_slot(key: Column, slots: int = 10_000) -> Column:
    """The first eight bytes of SHA-256 as an unsigned number, modulo the number of slots."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(slots)).cast("int")


def pool_pick(key: Column, salt: str, pool: list[str] | tuple[str, ...]) -> Column:
    """One of a pool's values, by the digest of key and salt."""
    at = (digest_u32(joined(key, salt)) % len(pool)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in pool]), at + 1)


def uniform(seed, slot, attempt, stage: str) -> Column:
    """A draw from [0, 1) by seed, slot, attempt and stage."""
    return digest_u32(joined(seed, slot, attempt, stage)) / F.lit(2.0**32)


def base64url(text: Column) -> Column:
    """The first eight bytes of SHA-256 in base64url without padding: 11 characters."""
    return F.rtrim(F.translate(F.base64(F.unhex(F.substring(F.sha2(text, 256), 1, 16))), "+/", "-_"), F.lit("="))


def question_id(path: Column, ordinal: Column) -> Column:
    """`a/b` and 1 to `a__b__q0001`; the root's path is empty and reads `root`."""
    name = F.when(path == "", F.lit("root")).otherwise(F.replace(path, F.lit("/"), F.lit("__")))
    return F.concat(name, F.format_string("__q%04d", ordinal))


def policy_record_id(ordinal: Column) -> Column:
    return F.format_string("policy_rec__%06d", ordinal)


def policy_text_id(policy_id: Column) -> Column:
    return F.concat(F.lit("policy_text__"), policy_id, F.lit("__r01"))


def person_id(record_id: Column) -> Column:
    return F.concat(F.lit("person__"), record_id, F.lit("__primary"))


def name_key(record_id: Column) -> Column:
    return F.format_string("name_slot_%04d", stable_slot(record_id))


def canonical_name(slot: Column, surnames, prefixes, suffixes) -> Column:
    """The name of a slot: mixed-radix digits of the slot pick a surname and two parts of a given name."""
    pick = lambda pool, at: F.element_at(F.array(*[F.lit(v) for v in pool]), at.cast("int") + 1)
    given = len(prefixes) * len(suffixes)
    rest = slot % given
    return F.concat(pick(surnames, F.floor(slot / given)), pick(prefixes, F.floor(rest / len(suffixes))), pick(suffixes, rest % len(suffixes)))


def first_mention(name: Column, kind: Column) -> Column:
    return F.concat(name, F.lit("["), kind, F.lit("]"))


def sample_id(*lineage) -> Column:
    return F.concat(F.lit("acml__"), F.substring(F.sha2(joined(*lineage), 256), 1, 20))


def id_component(text: Column) -> Column:
    """Letters, digits and underscores of an id, or 12 digits of its digest if none are left."""
    clean = F.trim(F.regexp_replace(strip_text(text), "[^A-Za-z0-9_]+", "_"), F.lit("_"))
    return F.when(clean == "", F.substring(F.sha2(text, 256), 1, 12)).otherwise(clean)


def sample_person_id(sample: Column, person: Column) -> Column:
    return F.concat(F.lit("person__sample__"), id_component(sample), F.lit("__"), F.substring(F.sha2(joined(sample, person), 256), 1, 12), F.lit("__primary"))


def rendered_person_id(sample: Column, person: Column) -> Column:
    return base64url(joined(sample, person, "rendered_entity_id"))


def artifact_ref(family, run, kind, name) -> Column:
    return F.concat_ws(":", *[_col(x) for x in (family, run, kind, name)])
