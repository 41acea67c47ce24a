"""Column functions over checksums, sizes and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import _c

SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")


def normalize_adler32(text: Column | str) -> Column:
    """The ``adler32:`` part of a checksum list as 8 (or more) lower-case hex digits."""
    text, pattern = _c(text), r"^\S*adler32:([^,]+)"
    value = F.lower(F.conv(F.trim(F.regexp_extract(text, pattern, 1)), 16, 16))
    padded = F.when(F.length(value) < 8, F.lpad(value, 8, "0")).otherwise(value)
    return F.when(text.rlike(pattern), padded)


def checksum_equal(a: Column | str, b: Column | str, how: str = "exact") -> Column:
    """``exact``; ``zeros``: without leading zeros; ``number``: as hex numbers."""
    a, b = _c(a), _c(b)
    if how == "exact":
        return a == b
    if how == "zeros":
        return F.ltrim(a, F.lit("0")) == F.ltrim(b, F.lit("0"))
    if how == "number":
        return F.conv(a, 16, 10) == F.conv(b, 16, 10)
    raise ValueError(how)


def storage_verdict(size: Column, checksum: Column, want_size: Column, want_checksum: Column) -> Column:
    """Storage against catalogue: ok or the first thing that is wrong."""
    return (
        F.when(size.isNull(), "no file found")
        .when(size != want_size, "wrong size")
        .when(~F.coalesce(checksum == want_checksum, F.lit(False)), "wrong checksum")
        .otherwise("ok")
    )


def _two_decimals(q: Column) -> Column:
    """Nearest multiple of 0.01 to the exact binary value, ties to even, for ``0 <= q < 2**20``.

    The value is split so that 200 times each part is exact; the sign of what is left over
    the midpoint then decides without rounding error.
    """
    low = F.floor(q * 100).cast("double")
    head = F.floor(q * 65536.0).cast("double") / 65536.0
    over = (head * 200.0 - (low * 2.0 + 1.0)) + (q - head) * 200.0
    up = F.when(over > 0, 1.0).when(over < 0, 0.0).otherwise(F.pmod(low, F.lit(2.0)))
    return (low + up) / 100.0


def _human(size: Column, base: int) -> Column:
    """Unit by comparison with exact powers; two decimals."""
    out = F.when(size == 0, F.lit("0B"))
    for i, unit in enumerate(SIZE_UNITS):
        if base**i > 2**63 - 1:
            break
        last = i + 1 >= len(SIZE_UNITS) or base ** (i + 1) > 2**63 - 1
        text = F.concat(_two_decimals(size / F.lit(float(base**i))).cast("string"), F.lit(" " + unit))
        out = out.when(F.lit(True) if last else size < F.lit(base ** (i + 1)), text)
    return F.when(size >= 0, out)


def human_size(size: Column | str) -> Column:
    return _human(_c(size), 1024)


def human_size_si(size: Column | str) -> Column:
    return _human(_c(size), 1000)


def epoch_to_ts(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_c(seconds))


def snapshot_day(now: Column | str, hour: int = 6) -> Column:
    """Day whose snapshot is complete: today from ``hour`` on, else yesterday."""
    return F.to_date(_c(now) - F.make_dt_interval(F.lit(0), F.lit(hour)))


def min_free_bytes(capacity: Column | str, percent: Column | str | None = None, default: float = 10.0) -> Column:
    share = F.lit(default) if percent is None else F.coalesce(_c(percent).cast("double"), F.lit(default))
    return F.floor(_c(capacity) * (share / 100.0)).cast("bigint")
