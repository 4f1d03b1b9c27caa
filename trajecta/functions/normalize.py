"""Normalization of single values by statistics, and its inverses. A null value or statistic gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trajecta.functions.vectors import binary, clipped

MODES = ("q99", "mean_std", "min_max", "scale", "binary")
#: Targets of a rotated absolute key, with the bounds its components have.
ROTATIONS = {"quaternion": 1.0, "rotation_6d": 1.0, "matrix": 1.0, "axis_angle": 3.141592653589793, "euler_angles": 3.141592653589793}


def q99(x: Column, q01: Column, q99_: Column) -> Column:
    """To [-1, 1] between the quantiles, passed through where they are equal; clamped in either case."""
    y = F.when(q01 == q99_, x).otherwise(2 * (x - q01) / (q99_ - q01) - 1)
    return clipped(y, -1.0, 1.0)


def mean_std(x: Column, mean: Column, std: Column) -> Column:
    return F.when(std == 0, x).otherwise((x - mean) / std)


def min_max(x: Column, low: Column, high: Column) -> Column:
    """To [-1, 1] between the extremes, 0 where they are equal; clamped."""
    return clipped(F.when(low == high, 0.0 * x).otherwise(2 * (x - low) / (high - low) - 1), -1.0, 1.0)


def scale(x: Column, low: Column, high: Column) -> Column:
    size = F.greatest(F.abs(low), F.abs(high))
    return F.when(size == 0, 0.0 * x).otherwise(x / size)


def q99_back(y: Column, q01: Column, q99_: Column) -> Column:
    return F.when(q01 == q99_, y).otherwise((y + 1) / 2 * (q99_ - q01) + q01)


def mean_std_back(y: Column, mean: Column, std: Column) -> Column:
    return F.when(std == 0, y).otherwise(y * std + mean)


def min_max_back(y: Column, low: Column, high: Column) -> Column:
    return (y + 1) / 2 * (high - low) + low


def normalized(mode: str, x: Column, stats: dict[str, Column]) -> Column:
    """x by mode; stats has mean, std, min, max, q01, q99 as far as the mode needs them."""
    if mode == "q99":
        return q99(x, stats["q01"], stats["q99"])
    if mode == "mean_std":
        return mean_std(x, stats["mean"], stats["std"])
    if mode == "min_max":
        return min_max(x, stats["min"], stats["max"])
    if mode == "scale":
        return scale(x, stats["min"], stats["max"])
    if mode == "binary":
        return binary(x)
    raise ValueError(f"unknown mode {mode}")


def restored(mode: str, y: Column, stats: dict[str, Column]) -> Column:
    """Inverse of normalized, up to clamping; scale has none."""
    if mode == "q99":
        return q99_back(y, stats["q01"], stats["q99"])
    if mode == "mean_std":
        return mean_std_back(y, stats["mean"], stats["std"])
    if mode == "min_max":
        return min_max_back(y, stats["min"], stats["max"])
    if mode == "binary":
        return binary(y)
    raise ValueError(f"{mode} has no inverse")


def check_mode(mode: str, continuous: bool = True, rotation: str | None = None, absolute: bool = True) -> None:
    """Refuses modes that make no sense for a key, before anything runs."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    if not continuous and mode != "binary":
        raise ValueError("a key that isn't continuous takes only binary")
    if rotation:
        if not absolute:
            raise ValueError("a relative key can't be rotated")
        if mode != "min_max" or rotation not in ROTATIONS:
            raise ValueError("a rotated key takes only min_max, with the bounds of its target")


def out_of_range(x: Column, low: Column, high: Column, slack: float = 1e-5) -> Column:
    """Whether min_max would clamp the value by more than slack of what it maps to: a reason to warn."""
    return F.coalesce((low != high) & (F.abs(2 * (x - low) / (high - low) - 1) > 1 + slack), F.lit(False))


def _by_horizon(f, mode: str, rows: Column, stats: dict[str, Column]) -> Column:
    steps = F.size(next(iter(stats.values())))
    fits = (F.size(rows) < steps) | (F.pmod(F.size(rows), steps) == 0)
    whole = F.when(fits | rows.isNull(), rows).otherwise(F.raise_error(F.concat(F.lit("rows must be fewer than the horizon or a multiple of it, got "), F.size(rows).cast("string"))))

    def row(v: Column, i: Column) -> Column:
        h = F.pmod(i, steps)
        return F.transform(v, lambda x, j: f(mode, x, {k: F.get(F.get(s, h), j) for k, s in stats.items()}))

    return F.transform(whole, row)


def normalized_by_horizon(mode: str, rows: Column, stats: dict[str, Column]) -> Column:
    """Rows of vectors by mode, each row by the statistics of its step: stats has arrays of the horizon's steps by components. Rows are
    one or several whole horizons, or the first steps of one."""
    return _by_horizon(normalized, mode, rows, stats)


def restored_by_horizon(mode: str, rows: Column, stats: dict[str, Column]) -> Column:
    """Inverse of normalized_by_horizon, up to clamping."""
    return _by_horizon(restored, mode, rows, stats)
