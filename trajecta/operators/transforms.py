"""Steps that transform a DataFrame and can undo it, composed from a registry of names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajecta.functions import normalize, rotations, vectors

REGISTRY: dict[str, type] = {}


def registered(name: str) -> Callable[[type], type]:
    def add(cls: type) -> type:
        REGISTRY[name] = cls
        return cls

    return add


class Step:
    """apply changes a DataFrame; unapply undoes that, or leaves it where the step has no inverse."""

    invertible = True

    def __init__(self) -> None:
        self.training = True

    def train(self) -> Step:
        self.training = True
        return self

    def eval(self) -> Step:
        self.training = False
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def unapply(self, df: DataFrame) -> DataFrame:
        return df


#: Widths that a rotation may have after its conversion: axis angle, quaternion, 6-d.
ROTATION_WIDTHS = (3, 4, 6)


@registered("concat")
class Concat(Step):
    """Vectors into one column, in order; unapply splits it.

    kind "action": the parts must be exactly the columns named by prefix. kind "state": they must be among the columns, and a part may
    have twice its width (sines and cosines). A part listed in rotations may also have the width of any representation; post gives the
    width that a part has here, where that isn't its own, for unapply.
    """

    def __init__(self, parts: list[tuple[str, int]], out: str, kind: str | None = None, prefix: str | None = None, rotations: list[str] | None = None, post: dict[str, int] | None = None):
        super().__init__()
        if kind not in (None, "state", "action"):
            raise ValueError(f"unknown kind {kind}")
        self.parts, self.out, self.kind, self.prefix, self.rotations, self.post = parts, out, kind, prefix, rotations or [], post or {}

    def widths(self, name: str, width: int) -> list[int]:
        """Widths that a part may have."""
        return sorted({width, *(ROTATION_WIDTHS if name in self.rotations else ()), *((2 * width,) if self.kind == "state" else ())})

    def apply(self, df: DataFrame) -> DataFrame:
        names = [n for n, _ in self.parts]
        if missing := sorted(set(names) - set(df.columns)):
            raise ValueError(f"no columns {missing}")
        if self.kind == "action" and self.prefix and (more := sorted({c for c in df.columns if c.startswith(self.prefix)} ^ set(names))):
            raise ValueError(f"keys differ from the columns by {more}")
        checked = [vectors.checked(F.col(f"`{n}`"), self.widths(n, w), n) for n, w in self.parts]
        return df.withColumn(self.out, vectors.stacked(*checked)).drop(*names)

    def unapply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(vectors.split(F.col(self.out), [(n, self.post.get(n, w)) for n, w in self.parts])).drop(self.out)


@registered("cast")
class Cast(Step):
    """Columns to another type; unapply restores the types they had."""

    def __init__(self, columns: list[str], to: str = "array<float>"):
        super().__init__()
        self.columns, self.to, self.had = columns, to, {}

    def apply(self, df: DataFrame) -> DataFrame:
        self.had = {c: df.schema[c].dataType for c in self.columns}
        return df.withColumns({c: F.col(c).cast(self.to) for c in self.columns})

    def unapply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).cast(t) for c, t in self.had.items() if c in df.columns})


@registered("normalize")
class Normalize(Step):
    """A vector column by literal statistics: one dict of the six numbers for each component."""

    def __init__(self, column: str, mode: str, stats: list[dict[str, float]]):
        super().__init__()
        normalize.check_mode(mode)
        self.column, self.mode, self.stats = column, mode, stats
        self.invertible = mode != "scale"

    def _each(self, df: DataFrame, f) -> DataFrame:
        names = sorted(set.intersection(*(set(s) for s in self.stats))) if self.stats else []
        arrays = {n: F.lit([float(s[n]) for s in self.stats]) for n in names}
        place = F.sequence(F.lit(0), F.lit(len(self.stats) - 1)) if self.stats else F.array().cast("array<int>")
        v = F.transform(place, lambda k: f(self.mode, F.get(self.column, k), {n: F.get(a, k) for n, a in arrays.items()}))
        return df.withColumn(self.column, F.when(F.col(self.column).isNotNull(), v))

    def apply(self, df: DataFrame) -> DataFrame:
        return self._each(df, normalize.normalized)

    def unapply(self, df: DataFrame) -> DataFrame:
        return self._each(df, normalize.restored) if self.invertible else df


@registered("rotate")
class Rotate(Step):
    """A rotation column from one representation to another."""

    def __init__(self, column: str, source: str, target: str):
        super().__init__()
        self.column, self.source, self.target = column, source, target

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, rotations.convert(F.col(self.column), self.source, self.target))

    def unapply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, rotations.convert(F.col(self.column), self.target, self.source))


@registered("sin_cos")
class SinCos(Step):
    invertible = False

    def __init__(self, column: str):
        super().__init__()
        self.column = column

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, vectors.sin_cos(F.col(self.column)))


@registered("perturb")
class Perturb(Step):
    """Normal noise in training, within the vector's own extremes."""

    invertible = False

    def __init__(self, column: str, std: float, seed: int = 0):
        super().__init__()
        if std < 0:
            raise ValueError("std must not be negative")
        self.column, self.std, self.seed = column, std, seed

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.training or not self.std:
            return df
        width = F.size(self.column)
        noise = F.transform(F.sequence(F.lit(1), width), lambda i: F.randn(self.seed) * self.std)
        c = F.col(self.column)
        moved = F.transform(F.zip_with(c, noise, lambda a, b: a + b), lambda x: vectors.clipped(x, F.array_min(c), F.array_max(c)))
        return df.withColumn(self.column, F.when(width > 0, moved).otherwise(c))


@registered("dropout")
class Dropout(Step):
    """Zeros instead of the vector for the share p of rows, in training."""

    invertible = False

    def __init__(self, column: str, p: float, seed: int = 0):
        super().__init__()
        self.column, self.p, self.seed = column, p, seed

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.training:
            return df
        return df.withColumn(self.column, F.when(F.rand(self.seed) < self.p, F.transform(self.column, lambda x: x * 0)).otherwise(F.col(self.column)))


class Chain(Step):
    """Steps one after the other; unapply goes back through those that can be undone. An error names the step."""

    def __init__(self, steps: list[Step]):
        super().__init__()
        self.steps = steps

    def train(self) -> Chain:
        for s in self.steps:
            s.train()
        return self

    def eval(self) -> Chain:
        for s in self.steps:
            s.eval()
        return self

    def _run(self, df: DataFrame, steps: list[tuple[int, Step]], what: str) -> DataFrame:
        for k, s in steps:
            try:
                df = getattr(s, what)(df)
            except Exception as e:
                raise ValueError(f"step {k} ({type(s).__name__}): {e}") from e
        return df

    def apply(self, df: DataFrame) -> DataFrame:
        return self._run(df, list(enumerate(self.steps)), "apply")

    def unapply(self, df: DataFrame) -> DataFrame:
        return self._run(df, [(k, s) for k, s in reversed(list(enumerate(self.steps))) if s.invertible], "unapply")


def built(configs: list[dict]) -> Chain:
    """A chain from configurations {"step": name, ...arguments}; only registered names are known."""
    steps = []
    for c in configs:
        c = dict(c)
        name = c.pop("step")
        if name not in REGISTRY:
            raise ValueError(f"unknown step {name}; known: {', '.join(sorted(REGISTRY))}")
        steps.append(REGISTRY[name](**c))
    return Chain(steps)
