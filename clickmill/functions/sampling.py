"""Repeatable sampling: the draw is a function of the row's key, never of the task that reads it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_draw(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) taken from the first 32 bits of md5("seed:key:key...")."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def sampled(label: Column, keys: Sequence[str], rates: Mapping[str, float], seed: int, inclusive: bool) -> Column:
    """True if the row stays. Labels without a rate always stay; ``inclusive`` compares with <=."""
    draw = key_draw(keys, seed)
    keep = F.lit(True)
    for name, rate in rates.items():
        keep = F.when(label == name, (draw <= rate) if inclusive else (draw < rate)).otherwise(keep)
    return keep


def keyed_sample(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    rates: Mapping[str, float],
    seed: int = 42,
    inclusive: bool = False,
) -> DataFrame:
    """Sample each label at its own rate. ``keys`` name the draw; put the label in for independent draws."""
    return df.filter(sampled(F.col(label), keys, rates, seed, inclusive))
