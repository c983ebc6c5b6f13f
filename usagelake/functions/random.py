"""Counter-based random numbers as Column expressions.

A value is a pure function of a seed, a stream name and the row's key, so it is the same for any
partitioning, order, retry or engine that knows MD5.  Nothing is drawn from a generator's state.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DIGITS = 15   # hexadecimal digits that make one value: below 2**60; a digest holds two values
ATTEMPTS = 2


def random_bits(key: Column, seed: int, stream: str, attempt: int = 0, digits: int = DIGITS) -> Column:
    """Uniform integer in ``[0, 16**digits)`` from the MD5 of ``seed|stream|n|key``.

    Attempts 2n and 2n + 1 read the two halves of digest n.
    """
    text = F.concat(F.lit(f"{seed}|{stream}|{attempt // 2}|"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1 + attempt % 2 * 15, digits), 16, 10).cast("bigint")


def uniform_int(n, key, seed: int = 0, stream: str = "", digits: int = DIGITS, attempts: int = ATTEMPTS) -> Column:
    """Uniform integer in ``[0, n)`` for each row, from its ``key`` column; NULL if ``n`` is not positive.

    ``n`` is a number or a column.  Values at or above the largest multiple of ``n`` are rejected and the
    next attempt's value is taken, so no result is favoured; after ``attempts`` rejections (each of
    a probability below ``n / 16**digits``) the last value is taken modulo ``n``.
    """
    k = F.col(key) if isinstance(key, str) else key
    size = n if isinstance(n, Column) else F.lit(int(n))
    size = size.cast("bigint")
    span = F.lit(16 ** digits).cast("bigint")
    fits = span - F.pmod(span, size)
    values = [random_bits(k, seed, stream, i, digits) for i in range(attempts)]
    tries = [F.when(v < fits, F.pmod(v, size)) for v in values]
    return F.when(size > 0, F.coalesce(*tries, F.pmod(values[-1], size)))
