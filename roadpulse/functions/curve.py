"""A key that follows a space-filling curve, so that near places have near keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of each coordinate; the key has twice as many. 2 ** 26 steps of latitude are 0.3 m each.
BITS = 26

# Half of what is left moves away at each step, until there is a gap of one bit between any two.
_SPREADS = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid_step(value: Column, low: float, high: float, bits: int = BITS) -> Column:
    """Which of ``2 ** bits`` equal steps from ``low`` to ``high`` the value lies in; null off the range and for NaN."""
    steps = 1 << bits
    step = F.floor((value - low) / F.lit((high - low) / steps))
    return F.when((value >= low) & (value <= high), F.least(step, F.lit(steps - 1)))


def interleaved(a: Column, b: Column) -> Column:
    """The bits of two numbers below ``2 ** 31`` in turn, those of ``b`` the higher of each two."""

    def spread(x: Column) -> Column:
        for shift, mask in _SPREADS:
            x = (x.bitwiseOR(F.shiftleft(x, shift))).bitwiseAND(F.lit(mask))
        return x

    return spread(a).bitwiseOR(F.shiftleft(spread(b), 1))


def curve_key(lat: str | Column, lng: str | Column, bits: int = BITS) -> Column:
    """Place on the Z-order curve over the globe, latitude and longitude in degrees.

    Null where a coordinate is null, NaN or off the globe.
    """
    return interleaved(grid_step(_col(lng), -180.0, 180.0, bits), grid_step(_col(lat), -90.0, 90.0, bits))
