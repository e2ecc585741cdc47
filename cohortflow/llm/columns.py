"""Column expressions over words, all built in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separators of words, \t \n \v \f \r and space.
BLANK = " \\t-\\r"


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+"), lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{BLANK}]+")).cast("bigint")


def let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def permuted(index: str, size: str, key: str, rounds: int = 4, walks: int = 64) -> Column:
    """SQL names `index` in [0, size): a pseudorandom permutation of [0, size), chosen by `key`.

    An alternating Feistel network over the next power of two, repeated until the result is in range: over
    half of its values are, so 64 repeats fail with probability below 2^-64, which is an error.
    """
    bits = f"greatest(length(bin({size} - 1)), 2)"
    low, high = f"cast({bits} div 2 as int)", f"cast({bits} - {bits} div 2 as int)"

    def ones(n: str) -> str:
        return f"(shiftleft(1L, {n}) - 1)"

    def once(x: str) -> str:
        for r in range(rounds):
            if r % 2 == 0:  # the low half changes the high one
                change = f"shiftleft(xxhash64(x & {ones(low)}, {key}, {r}) & {ones(high)}, {low})"
            else:
                change = f"xxhash64(shiftright(x, {low}), {key}, {r}) & {ones(low)}"
            x = f"element_at(transform(array({x}), x -> x ^ ({change})), 1)"
        return x

    first = once(f"cast({index} as bigint)")
    walked = f"aggregate(sequence(1, {walks}), {first}, (v, i) -> if(v < {size}, v, {once('v')}))"
    stop = "cast(raise_error('no place found') as bigint)"
    return F.expr(f"element_at(transform(array({walked}), v -> if(v < {size}, v, {stop})), 1)")
