"""Identifiers and storage keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadloom.functions.times import epoch_seconds, from_epoch_micros
from quadloom.vocab import CONTAINER_MODELS, DEFAULTS, VERSION_MARK, Settings

# Fixed value: a scheme, a colon, then none of the characters an IRI may not hold.
IRI_PATTERN = r"\A[A-Za-z][A-Za-z0-9+.-]*:[^\x00-\x20\x7F<>\"{}|\\^`]*\z"

VERSION_PATTERN = r"(?s)\A(?:(?!\?version=).)*+\?version=([+-]?[0-9]+)\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_container(model: Column | str) -> Column:
    return _col(model).isin(*CONTAINER_MODELS)


def with_slash(identifier: Column | str, model: Column | str | None = None) -> Column:
    """End a container's identifier with a slash; ``model=None`` means a container."""
    identifier = _col(identifier)
    lacks = ~identifier.endswith("/")
    if model is not None:
        lacks = lacks & is_container(model)
    return F.when(lacks, F.concat(identifier, F.lit("/"))).otherwise(identifier)


def binary_key(identifier: Column | str, settings: Settings = DEFAULTS) -> Column:
    """Object key of a binary; null when the identifier has another scheme."""
    identifier = _col(identifier)
    scheme = settings.binary_scheme
    rest = F.substring(identifier, len(scheme) + 1, 2_147_483_647)
    return F.when(identifier.startswith(scheme), F.concat(F.lit(settings.binary_key_prefix), rest))


def version_key_stem(identifier: Column | str, settings: Settings = DEFAULTS) -> Column:
    """Prefix shared by the keys of all versions of a resource."""
    path = F.substring(_col(identifier), len(settings.data_prefix) + 1, 2_147_483_647)
    return F.concat(F.lit(settings.version_key_prefix), path, F.lit(VERSION_MARK))


def stem_of_version_key(key: Column | str) -> Column:
    """The part of a key up to its first version mark and with it; null when it has none."""
    key = _col(key)
    at = F.instr(key, VERSION_MARK)
    return F.when(at > 0, F.substring(key, F.lit(1), at + (len(VERSION_MARK) - 1)))


def version_key(identifier: Column | str, time: Column | str, settings: Settings = DEFAULTS) -> Column:
    return F.concat(version_key_stem(identifier, settings), epoch_seconds(time).cast("string"))


def identifier_of_version_key(key: Column | str, settings: Settings = DEFAULTS) -> Column:
    key = _col(key)
    prefix = settings.version_key_prefix
    if prefix:
        bare = F.substring(key, len(prefix) + 1, 2_147_483_647)
        key = F.when(key.startswith(prefix), bare).otherwise(key)
    return F.concat(F.lit(settings.data_prefix), F.substring_index(key, VERSION_MARK, 1))


def version_text_of_key(key: Column | str) -> Column:
    """What follows the version mark; null when the key has no mark."""
    key = _col(key)
    at = F.instr(key, VERSION_MARK)
    text = key.substr(at + len(VERSION_MARK), F.lit(2_147_483_647))
    return F.when(at > 0, text)


def version_of_key(key: Column | str) -> Column:
    """Version time in a key; null when there is none or it is not a whole number.

    What counts is all that follows the first mark. Numbers that no instant
    can hold, of 13 digits or more, give null too.
    """
    seconds = F.regexp_extract(_col(key), VERSION_PATTERN, 1).try_cast("bigint")
    # The product overflows to null where an instant would; with a comparison, every key would be matched more than once.
    return from_epoch_micros(F.try_multiply(seconds, F.lit(1_000_000).cast("bigint")))


def iri_or_null(text: Column | str) -> Column:
    """Null and empty text both stand for no IRI."""
    return F.nullif(_col(text), F.lit(""))


def iri_status(text: Column | str) -> Column:
    """``null``, ``valid`` or ``invalid``."""
    iri = iri_or_null(text)
    return (
        F.when(iri.isNull(), F.lit("null"))
        .when(iri.rlike(IRI_PATTERN), F.lit("valid"))
        .otherwise(F.lit("invalid"))
    )


def text_to_bytes(text: Column | str) -> Column:
    return F.encode(_col(text), "UTF-8")


def bytes_to_text(content: Column | str) -> Column:
    return F.decode(_col(content), "UTF-8")


def mint_identifier(prefix: str = "") -> Column:
    """A new random identifier. Write the result before using it twice."""
    return F.concat(F.lit(prefix), F.uuid())
