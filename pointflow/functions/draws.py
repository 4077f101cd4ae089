"""Random draws as pure functions of (seed, stream name, id).

A draw does not depend on partitioning or on the number of attempts, so a lost
executor can recompute its rows. One MD5 digest gives two independent uniforms
of 48 bits each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 48
HEX_DIGITS = DRAW_BITS // 4


def _digest(seed: int, stream: str, ident: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{stream}:"), ident.cast("string")))


def _unit(digest: Column, start: int) -> Column:
    hexits = F.substring(digest, start, HEX_DIGITS)
    return (F.conv(hexits, 16, 10).cast("double") + 0.5) / F.lit(float(2**DRAW_BITS))


def uniform_pair(seed: int, stream: str, ident: Column) -> Column:
    """struct(u, v), both in the open interval (0, 1)."""
    digest = _digest(seed, stream, ident)
    return F.struct(_unit(digest, 1).alias("u"), _unit(digest, 1 + HEX_DIGITS).alias("v"))


def gaussian_pair(pair: Column) -> Column:
    """struct(x, y) of two independent standard normals from a `uniform_pair` (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(pair["u"]))
    angle = F.lit(2.0 * math.pi) * pair["v"]
    return F.struct((radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y"))


def salt(parts: int, *keys: Column | str) -> Column:
    """A bucket in [0, parts) that is the same at every attempt."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
