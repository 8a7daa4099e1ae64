"""Normal forms of capture fields: time, digest, source.  Native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def time14(ts: Column) -> Column:
    """The 14 digits of a complete, valid time in any of the usual notations, else null."""
    t = F.trim(ts)
    digits = F.regexp_replace(t, r"[-:TZ /.]", "")
    full = F.when(digits.rlike(r"^[0-9]{14}$"), digits)
    return F.when(F.try_to_timestamp(full, F.lit("yyyyMMddHHmmss")).isNotNull(), full)


def hex_to_base32(h: Column) -> Column:
    """40 hex digits as 32 base32 symbols: each 5 digits are 20 bits, so 4 symbols."""

    def four(i: int) -> list[Column]:
        n = F.conv(F.substring(h, 5 * i + 1, 5), 16, 10).cast("int")
        return [F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]

    return F.concat(*[c for i in range(8) for c in four(i)])


def digest32(d: Column) -> Column:
    """A complete SHA-1 digest as 32 upper-case base32 symbols, else null."""
    bare = F.regexp_replace(F.trim(d), r"(?i)^sha1:", "")
    up = F.upper(bare)
    return F.when(bare.rlike(r"^[0-9A-Fa-f]{40}$"), hex_to_base32(F.lower(bare))).when(
        up.rlike(r"^[A-Z2-7]{32}$"), up
    )


def source_key(s: Column) -> Column:
    return F.nullif(F.lower(F.trim(s)), F.lit(""))
