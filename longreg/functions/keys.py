"""Match keys and surrogate identifiers as plain column expressions."""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .blank import all_filled, as_text

UUID_DIGITS = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def filled_text(name: str) -> str:
    """SQL for the trimmed text of a column, NULL when blank."""
    return f"nullif(trim(CAST({quoted(name)} AS STRING)), '')"


def key_of(texts: list[str], allow_blank: bool = False) -> Column:
    """One string from SQL texts, each behind its own length, so that joined parts stay
    unambiguous whatever they hold ("a1","23" and "a12","3" differ). NULL if a part is
    NULL, unless blanks are allowed, in which case they equal each other.

    Built as one SQL expression: a cascade has dozens of parts, and each Column call is
    a round trip to the JVM.
    """
    parts = [f"coalesce({t}, '')" if allow_blank else t for t in texts]
    return F.expr("concat(" + ", '|', ".join(f"length({p}), ':', {p}" for p in parts) + ")")


def key_text(names: list[str], allow_blank: bool = False) -> Column:
    return key_of([filled_text(n) for n in names], allow_blank)


#: 128 bits decide whether two keys are equal, as many as an id has.
KEY_DIGITS = 32


def key_digest(key: Column) -> Column:
    """A key for joins as 16 bytes of its SHA-256, whatever its length. NULL stays NULL."""
    return F.unhex(F.substring(F.sha2(key.cast("binary"), 256), 1, KEY_DIGITS))


UUID_TEXT = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: Put before other texts, so that none is packed to the 16 bytes of a UUID.
PLAIN = "-" * 17


def packed(text: Column) -> Column:
    """An id as bytes: 16 for a UUID in its usual form, any other text as it is behind a mark."""
    return F.when(text.rlike(UUID_TEXT), F.unhex(F.replace(text, F.lit("-"), F.lit("")))).otherwise(
        F.concat(F.lit(PLAIN), text).cast("binary"))


def is_short(value: Column) -> Column:
    """Whether a packed text is a UUID in its usual form. Among these, and among the others, the order is that of the texts."""
    return F.octet_length(value) == KEY_DIGITS // 2


def unpacked(value: Column) -> Column:
    """The text that was packed."""
    uuid = F.regexp_replace(F.lower(F.hex(value)), UUID_DIGITS, "$1-$2-$3-$4-$5")
    return F.when(is_short(value), uuid).otherwise(
        F.substr(value.cast("string"), F.lit(len(PLAIN) + 1)))


def sized(part: Column) -> Column:
    return F.concat(F.length(part).cast("string"), F.lit(":"), part)


#: Block length of SHA-256 in bytes, and the two fixed bytes of HMAC.
BLOCK, INNER, OUTER = 64, 0x36, 0x5C


def hmac_pads(secret: str) -> tuple[bytes, bytes]:
    """The secret as the two blocks that HMAC-SHA256 puts before what it hashes."""
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > BLOCK else key).ljust(BLOCK, b"\0")
    return bytes(b ^ INNER for b in key), bytes(b ^ OUTER for b in key)


@functools.lru_cache(maxsize=64)
def _pads(application: str, secret: str) -> DataFrame:
    """One row, the same for all plans of an application, so that a plan reads it once."""
    return SparkSession.active().createDataFrame([hmac_pads(secret)], "inner binary, outer binary")


def keyed_id(secret: str, namespace: str, parts: list[Column]) -> Column:
    """Identifier derived from the parts under a secret by HMAC-SHA256, in UUID layout.

    The same input gives the same id on every run, retry and cluster; the secret
    keeps enumerable register numbers from being recovered by brute force. The
    namespace keeps ids of different kinds apart. The secret is data of a one-row table that
    the query reads, so it is in no plan, and neither in logs nor in the history server.
    """
    pads = _pads(SparkSession.active().sparkContext.applicationId, secret).select(F.struct("inner", "outer")).scalar()
    message = F.concat_ws("|", F.lit(namespace), *[sized(p) for p in parts]).cast("binary")
    inner = F.unhex(F.sha2(F.concat(pads["inner"], message), 256))
    digest = F.sha2(F.concat(pads["outer"], inner), 256)
    # One expression over one digest: slicing it five times would hash five times.
    return F.regexp_replace(F.substring(digest, 1, 32), UUID_DIGITS, "$1-$2-$3-$4-$5")


def surrogate_id(df: DataFrame, secret: str, namespace: str, names: list[str],
                 allow_blank: bool = False) -> Column:
    made = keyed_id(secret, namespace, [as_text(F.col(n)) for n in names])
    return made if allow_blank else F.when(all_filled(df, names), made)
