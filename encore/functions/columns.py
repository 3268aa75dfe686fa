"""Column expressions shared by the operators.  All are JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order_key(cols: Sequence[str], salt: str | None = None, types: Mapping[str, str] = {}) -> Column:
    """Stable pseudo-random order: ``md5(concat_ws('|', [salt,] c1, c2, ...))``.

    Unlike ``rand(seed)`` it does not depend on partition layout, so a split is
    reproduced exactly when a lost executor's tasks are recomputed, and the same
    text gives the same order in any SQL engine with ``md5``.  ``types`` (column ->
    Spark type name) lets time-zone dependent types be written independently of it.
    """
    parts = [key_text(c, types.get(c)) for c in cols]
    if salt is not None:
        parts = [F.lit(salt)] + parts
    return F.md5(F.concat_ws("|", *parts))


def key_text(col: str, kind: str | None = None) -> Column:
    """A key as text that does not depend on the session: a timestamp as microseconds since the epoch."""
    if kind == "timestamp":
        return F.unix_micros(F.col(col)).cast("string")
    return F.col(col).cast("string")


def split_rule(rank: Column, n: Column, frac: float = 0.8) -> Column:
    """``rank <= (n + 1) * frac`` in exact integer arithmetic.

    ``frac`` is taken as a fraction p/q (0.8 -> 4/5), so the test is
    ``q * rank <= p * (n + 1)``: users with few rows keep them all in train
    (n = 1..4 -> all train, n = 5 -> 4 train / 1 validation).
    """
    f = Fraction(frac).limit_denominator(1_000_000)
    big = lambda c: c.cast("long")  # noqa: E731  a user's rank times the denominator passes 32 bits
    return F.lit(f.denominator).cast("long") * big(rank) <= F.lit(f.numerator).cast("long") * (big(n) + F.lit(1))


def damped_mean(total: Column, n_users: Column, beta: float) -> Column:
    """``sum(count) / (n_users + beta)``: mean count per listener shrunk toward 0."""
    if beta < 0:
        raise ValueError("beta must be >= 0")
    return total / (n_users + F.lit(beta))


def weighted_popularity(total: Column, n_users: Column, beta: float = 0) -> Column:
    """``sum(count) * (n_users + beta)``: DECIMAL(38,0) for a whole beta, else DOUBLE.

    The product of two BIGINT sums passes 64 bits on large inputs, so a whole beta
    is computed exactly in decimals.
    """
    if beta < 0:
        raise ValueError("beta must be >= 0")
    if float(beta).is_integer():
        return total.cast("decimal(20,0)") * (n_users + F.lit(int(beta))).cast("decimal(17,0)")
    return total.cast("double") * (n_users + F.lit(float(beta)))


def ideal_dcg(m: Column) -> Column:
    """``sum_{j < m} 1 / ln(j + 2)`` for a per-row length ``m`` (0 when m = 0)."""
    total = F.aggregate(
        F.sequence(F.lit(0), m.cast("int") - F.lit(1)),
        F.lit(0.0).cast("double"),
        lambda acc, j: acc + F.lit(1.0) / F.log(j.cast("double") + F.lit(2.0)),
    )
    return F.when(m > 0, total).otherwise(F.lit(0.0))


def rounded(col: Column | str, places: int = 9) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, places)
