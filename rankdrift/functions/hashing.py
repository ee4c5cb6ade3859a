"""Element ids and the families of hash functions used for MinHash.

Everything here returns a Spark ``Column`` built from JVM functions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\u0001"

# An element id has 60 bits: the upper 31 go through the affine functions, the
# lower 29 break ties. With a 31-bit hash alone, sets of more than a few hundred
# million elements would reach the same minima by chance.
LOW_BITS = 29
PRIME = 2**31 - 1

# These coefficient pairs (a, b) have to equal the ones existing
# signatures were made with.
COMPAT_COEFFICIENTS = (
    (62, 92), (27, 59), (22, 31), (55, 25), (96, 25),
    (90, 87), (21, 5), (29, 50), (18, 26), (75, 20),
    (28, 65), (8, 9), (47, 68), (60, 90), (42, 50),
    (68, 67), (92, 39), (10, 62), (34, 72), (96, 92),
    (10, 11), (15, 25), (48, 89), (82, 40), (95, 62),
    (23, 39), (28, 71), (88, 85), (65, 22), (96, 19),
    (77, 55), (89, 15), (35, 48), (4, 70), (8, 60),
    (22, 88), (81, 94), (63, 86), (52, 83), (100, 29),
    (32, 13), (96, 62), (37, 1), (6, 16), (99, 6),
    (55, 38), (41, 15), (6, 77), (51, 47), (65, 78),
    (20, 70), (81, 76), (60, 54), (67, 73), (36, 45),
    (93, 34), (40, 19), (9, 21), (59, 93), (50, 53),
    (97, 16), (24, 85), (44, 55), (67, 73), (74, 14),
    (41, 45), (45, 10), (39, 60), (80, 70), (8, 82),
    (63, 29), (70, 95), (47, 40), (50, 31), (84, 95),
    (99, 2), (37, 98), (14, 63), (43, 7), (99, 68),
    (10, 23), (97, 90), (82, 32), (20, 59), (5, 18),
    (67, 32), (43, 88), (16, 82), (27, 73), (88, 38),
    (78, 23), (26, 84), (71, 80), (40, 85), (43, 76),
    (95, 6), (66, 99), (11, 67), (73, 73), (77, 48),
)


def null_to_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def element_text(columns: Sequence[str], separator: str = SEPARATOR) -> Column:
    """One string per element; NULL counts as empty and keeps its place."""
    return F.concat_ws(separator, *[null_to_empty(c) for c in columns])


def md5_id(columns: Sequence[str]) -> Column:
    """60-bit element id that any SQL engine can compute again."""
    digest = F.md5(element_text(columns).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def xxhash_id(columns: Sequence[str]) -> Column:
    """60-bit element id, several times cheaper than ``md5_id``.

    The columns are hashed one after the other, so no string is put together.
    """
    return F.shiftrightunsigned(F.xxhash64(*[null_to_empty(c) for c in columns]), 4)


ELEMENT_IDS = {"md5": md5_id, "xxhash64": xxhash_id}


def coefficients(k: int, seed: int = 1) -> tuple[tuple[int, int], ...]:
    """``k`` reproducible pairs (a, b) with 1 <= a < PRIME and 0 <= b < PRIME."""

    def draw(name: str, i: int) -> int:
        return int(hashlib.md5(f"{seed}:{name}:{i}".encode()).hexdigest()[:15], 16)

    return tuple((draw("a", i) % (PRIME - 1) + 1, draw("b", i) % PRIME) for i in range(k))


def split_id(element_id: Column) -> tuple[Column, Column]:
    """The two parts of a 60-bit element id that ``affine_hash`` works on."""
    low = element_id.bitwiseAND(F.lit(2**LOW_BITS - 1))
    return F.shiftright(element_id, LOW_BITS), low


def affine_hash(high: str, low: str, a: int, b: int) -> str:
    """SQL text of one 60-bit hash value; no step of it can overflow a BIGINT.

    Text, as a signature takes a hundred of these and one parsed expression is
    much quicker to hand to Spark than a tree of columns.
    """
    return f"shiftleft(({high} * {a}L + {b}L) % {PRIME}L, {LOW_BITS}) + {low}"


def compat_hash(seed: str, a: int, b: int, modulus: int) -> str:
    """SQL text of an affine hash in wrapping 32-bit arithmetic, its sign folded away."""
    wrapped = f"(({seed} * {a}L + {b}L + {2**31}L) & {2**32 - 1}L) - {2**31}L"
    return f"abs(({wrapped}) % {modulus}L)"


def first_prime_from(n: int) -> int:
    """The least prime that is not below ``n``."""
    candidate = max(n, 2)
    while any(candidate % divisor == 0 for divisor in range(2, isqrt(candidate) + 1)):
        candidate += 1
    return candidate


def wrap_int32(value: Column) -> Column:
    """The signed 32-bit integer that ``value`` overflows to."""
    return (value + 2**31).bitwiseAND(F.lit(2**32 - 1)) - 2**31


def string_hash32(text: Column) -> Column:
    """Signed 32-bit ``31 * h + unit`` hash over the UTF-16 code units of ``text``."""

    def add(state: Column, unit: Column) -> Column:
        return (state * 31 + unit).bitwiseAND(F.lit(2**32 - 1))

    def add_character(state: Column, character: Column) -> Column:
        code = F.ascii(character).cast("bigint")
        above = code - 0x10000
        high = F.shiftright(above, 10) + 0xD800
        low = above.bitwiseAND(F.lit(0x3FF)) + 0xDC00
        return F.when(above < 0, add(state, code)).otherwise(add(add(state, high), low))

    zero = F.lit(0).cast("bigint")
    characters = F.split(text, "")
    # Most text is ASCII, where a character is a code unit and the step is simple.
    plain = F.aggregate(characters, zero, lambda state, c: add(state, F.ascii(c)))
    full = F.aggregate(characters, zero, add_character)
    folded = F.when(F.octet_length(text) == F.length(text), plain).otherwise(full)
    return wrap_int32(F.when(F.length(text) == 0, zero).otherwise(folded))
