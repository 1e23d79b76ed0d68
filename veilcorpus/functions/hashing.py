"""Seeded draws that depend only on the row, never on partitioning or retries.

Every random choice is an integer taken from md5 over `seed:salt:key...`. A
task that is run again, on another executor or with another partition count,
draws the same numbers; `rand()` would not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DRAW_BITS = 52


def draw(seed: int, *keys: Column | str | int) -> Column:
    """Integer in [0, 2^52) for the given keys. Plain str and int keys are literals."""
    parts = [F.lit(str(seed))]
    parts += [k if isinstance(k, Column) else F.lit(str(k)) for k in keys]
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def bit_of(bits: Column, place: Column) -> Column:
    """Whether the bit at `place`, counted from 0, is set in a bitmap of `bitmap_construct_agg`."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place % 8) == 1


def unit(drawn: Column) -> Column:
    """Double in the open interval (0, 1)."""
    return (drawn + F.lit(0.5)) / F.lit(float(1 << DRAW_BITS))
