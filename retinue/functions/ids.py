"""Identity expressions: device ids, decorated uids and raw search keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4_294_967_296
LOW_32 = 0xFFFFFFFF


def normalise_orig_id(orig_id: Column) -> Column:
    return F.lower(orig_id)


def is_filled(c: Column) -> Column:
    return F.trim(c) != ""


def md5uid(uid: Column) -> Column:
    """Decorate a uid with the first byte of its MD5; '' when it is not a number.

    The low 32 bits stay the inner uid, so ``truncate_uid`` undoes it.
    """
    hash_byte = F.conv(F.substring(F.md5(uid), 1, 2), 16, 10).cast("bigint")
    decorated = uid.try_cast("bigint") + hash_byte * F.lit(TWO_POW_32)
    return F.coalesce(decorated.cast("string"), F.lit(""))


MD5UID_SQL = (
    "CREATE OR REPLACE TEMPORARY FUNCTION md5uid(u STRING) RETURNS STRING RETURN "
    "coalesce(cast(try_cast(u AS BIGINT) + "
    "cast(conv(substr(md5(u), 1, 2), 16, 10) AS BIGINT) * 4294967296 AS STRING), '')"
)


def truncate_uid(uid: Column) -> Column:
    return uid.try_cast("bigint").bitwiseAND(F.lit(LOW_32))


def search_row_key(day: Column, event: Column, decorated_uid: Column) -> Column:
    """Binary key: 8-char day, event path, one separator byte, 5-byte big-endian uid."""
    uid_hex = F.lpad(F.hex(decorated_uid.try_cast("bigint")), 10, "0")
    return F.concat(
        F.encode(F.concat(day, event), "UTF-8"), F.unhex(F.lit("FF")), F.unhex(uid_hex)
    )


def decode_row_key(key: Column) -> Column:
    size = F.octet_length(key)
    return F.struct(
        F.decode(F.substring(key, 1, 8), "UTF-8").alias("day"),
        F.decode(F.substring(key, F.lit(9), size - 14), "UTF-8").alias("event"),
        F.conv(F.hex(F.substring(key, size - 4, F.lit(5))), 16, 10).cast("bigint").alias("uid"),
    )
