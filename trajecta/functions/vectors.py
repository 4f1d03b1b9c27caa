"""Packed vectors as array columns, with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice_of(vector: Column, start: int, end: int) -> Column:
    """Components start to end - 1; null for a null vector."""
    return F.slice(vector, start + 1, end - start)


def as_vector(value: Column) -> Column:
    """A scalar as a vector of one component."""
    return F.array(value)


def stacked(*vectors: Column) -> Column:
    """Vectors end to end; null if any is."""
    return F.concat(*vectors)


def slice_catalog(widths: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
    """(name, start, end) of each part of the vector that the parts make end to end."""
    out, at = [], 0
    for name, w in widths:
        out.append((name, at, at + w))
        at += w
    return out


def velocity_pair(velocity: Column) -> Column:
    """A velocity of one component gets a zero after it; of a longer one the first two are kept."""
    return F.when(F.size(velocity) == 1, F.concat(velocity, F.array(F.lit(0.0)))).otherwise(F.slice(velocity, 1, 2))


def checked(vector: Column, width: int | list[int], what: str) -> Column:
    """The vector, or an error where it has none of the widths allowed."""
    widths = [width] if isinstance(width, int) else width
    message = F.concat(F.lit(f"{what}: {' or '.join(map(str, widths))} components expected, got "), F.size(vector).cast("string"))
    return F.when(F.size(vector).isin(widths) | vector.isNull(), vector).otherwise(F.raise_error(message))


def split(vector: Column, widths: list[tuple[str, int]]) -> dict[str, Column]:
    """The parts of a vector by name; undoes stacked."""
    return {name: slice_of(vector, a, b) for name, a, b in slice_catalog(widths)}


def padded(vector: Column, width: int) -> Column:
    """Zeros up to width; longer vectors are cut."""
    return F.slice(F.concat(vector, F.array_repeat(F.lit(0.0), width)), 1, width)


def padded_strictly(vector: Column, width: int) -> Column:
    """Zeros up to width; longer vectors are an error."""
    return F.when(F.size(vector) > width, F.raise_error(F.lit(f"vector longer than {width}"))).otherwise(padded(vector, width))


def pad_mask(vector: Column, width: int) -> Column:
    """True for the components of padded that are the vector's."""
    n = F.size(vector)
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: i < n)


def action_rows(rows: Column, horizon: int, width: int) -> tuple[Column, Column]:
    """Rows of an action padded with zeros to width, and the mask of what is the action's; zeros and no mask over horizon rows for a null
    action. Rows that aren't a multiple of the horizon, or are longer than width, are an error."""
    n, most = F.size(rows), F.array_max(F.transform(rows, F.size))
    checked_rows = F.when(F.pmod(n, F.lit(horizon)) != 0, F.raise_error(F.concat(F.lit(f"rows must be a multiple of {horizon}, got "), n.cast("string"))))
    checked_rows = checked_rows.when(most > width, F.raise_error(F.concat(F.lit(f"at most {width} components, got "), most.cast("string")))).otherwise(rows)
    none = F.array_repeat(F.array_repeat(F.lit(0.0), width), horizon)
    nothing = F.array_repeat(F.array_repeat(F.lit(False), width), horizon)
    return F.when(rows.isNull(), none).otherwise(F.transform(checked_rows, lambda v: padded(v, width))), F.when(rows.isNull(), nothing).otherwise(F.transform(rows, lambda v: pad_mask(v, width)))


def equal_parts(rows: Column, parts: int, strict: bool = False) -> Column:
    """An array in parts of equal size, the first ones one longer where it doesn't divide; that is an error if strict."""
    n = F.size(rows)
    short = F.floor(n / parts)
    longer = n - short * parts
    out = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.slice(rows, (k * short + F.least(k, longer) + 1).cast("int"), (short + F.when(k < longer, 1).otherwise(0)).cast("int")))
    return F.when(longer != 0, F.raise_error(F.lit(f"not divisible by {parts}"))).otherwise(out) if strict else out


def batched(vectors_: dict[str, Column]) -> dict[str, Column]:
    """A leading dimension of one for each."""
    return {n: F.array(v) for n, v in vectors_.items()}


def unbatched(arrays: dict[str, Column]) -> dict[str, Column]:
    """The only element of each; an error where one has none or several."""
    return {n: F.when((F.size(a) == 1) | a.isNull(), F.get(a, F.lit(0))).otherwise(F.raise_error(F.concat(F.lit(f"{n}: leading dimension 1 expected, got "), F.size(a).cast("string")))) for n, a in arrays.items()}


def flat_index(index: list[Column], shape: list[int]) -> Column:
    """Row-major number of a multi-index."""
    out = F.lit(0)
    for i, n in zip(index, shape):
        out = out * n + i
    return out


def multi_index(flat: Column, shape: list[int]) -> list[Column]:
    """Undoes flat_index."""
    out: list[Column] = []
    for n in reversed(shape):
        out.insert(0, F.pmod(flat, F.lit(n)))
        flat = F.floor(flat / n)
    return out


def multi_one_hot(values: list[Column], classes: list[int]) -> Column:
    """Each value's indicator vector, end to end."""

    def one(v: Column, c: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(c - 1)), lambda i: (i == v).cast("int"))

    return F.concat(*[one(v, c) for v, c in zip(values, classes)])


def rows_of(**arrays: Column) -> Column:
    """Arrays of equal length as an array of structs; shorter ones end in nulls."""
    return F.arrays_zip(*[a.alias(n) for n, a in arrays.items()])


def sin_cos(vector: Column) -> Column:
    """Sines of all components, then cosines."""
    return F.concat(F.transform(vector, F.sin), F.transform(vector, F.cos))


def binary(x: Column) -> Column:
    return (x > 0.5).cast("double")


def clipped(x: Column, low: Column | float, high: Column | float) -> Column:
    """x within low and high; null stays null, a null bound is none."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, high if isinstance(high, Column) else F.lit(high)), low if isinstance(low, Column) else F.lit(low)))


def rescaled_effector(x: Column) -> Column:
    """Fixed values of the gripper scale: 35 is closed, 120 is open."""
    return clipped((x - 35.0) / 85.0, 0.0, 1.0)


def to_bytes(x: Column, low: Column, high: Column) -> Column:
    """0..255 from [-1, 1] where the values lie there, else from low..high."""
    scaled = F.when((low >= -1.0) & (high <= 1.0), (x + 1.0) * 127.5).otherwise((x - low) / F.greatest(high - low, F.lit(1e-6)) * 255.0)
    return F.floor(clipped(scaled, 0.0, 255.0)).cast("int")


def mean_of(vector: Column) -> Column:
    return F.when(F.size(vector) > 0, F.aggregate(vector, F.lit(0.0), lambda a, x: a + x) / F.size(vector))


def variance_of(vector: Column, unbiased: bool = False) -> Column:
    """Variance of a vector's components."""
    m = mean_of(vector)
    squares = F.aggregate(F.transform(vector, lambda x: (x - m) * (x - m)), F.lit(0.0), lambda a, x: a + x)
    n = F.size(vector) - (1 if unbiased else 0)
    return F.when(n > 0, squares / n)


def last_argmax(vector: Column) -> Column:
    """Position of the greatest component, the last of equal ones."""
    return F.array_max(F.transform(vector, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))["i"]


def with_gripper(seven: Column, gripper: Column) -> Column:
    """Seven joint values and one gripper value as a vector of eight; zeros for missing parts."""
    return F.concat(F.coalesce(padded(seven, 7), F.array_repeat(F.lit(0.0), 7)), F.array(F.coalesce(gripper, F.lit(0.0))))
