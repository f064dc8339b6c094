"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymend.schema import SURROGATE

_LOW_NIBBLES = 0x0F0F0F0F0F0F0F0F
_TWO_POW_64 = str(2**64)


def surrogate_key(*columns: str | Column) -> Column:
    """Unsigned 64-bit key of the given columns, as ``decimal(20,0)``.

    The value is the first eight MD5 bytes of the ``|``-joined text, read little-endian.
    NULL and the empty string give the same key, and ``|`` in a value is not escaped.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("|", *parts))
    # Reversing the hex text reverses the bytes but also the two digits of each; the shifts put those
    # right. Working on a long spares slicing the text byte by byte.
    turned = F.conv(F.reverse(F.substring(digest, 1, 16)), 16, -10).cast("bigint")
    low = F.lit(_LOW_NIBBLES)
    signed = F.shiftleft(turned.bitwiseAND(low), 4).bitwiseOR(F.shiftrightunsigned(turned, 4).bitwiseAND(low))
    value = signed.cast(SURROGATE)
    return F.when(signed < 0, value + F.lit(_TWO_POW_64).cast(SURROGATE)).otherwise(value).cast(SURROGATE)
