"""Reading and writing datasets: episode files by chunk, JSON metadata, catalogs, path patterns."""

from __future__ import annotations

import copy
import fnmatch
import json
import re
from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPISODES_A_CHUNK = 1000
LANGUAGE_KEYS = ("annotation.task", "annotation.language.language_instruction")
PARTITION = "episode_chunk"


# scans


def read_frames(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All episode files below path; missing files are skipped."""
    r = spark.read.option("ignoreMissingFiles", "true").option("recursiveFileLookup", "false")
    return (r.schema(schema) if schema else r).parquet(path)


def read_episode(frames: DataFrame, episode: int, per_chunk: int = EPISODES_A_CHUNK) -> DataFrame:
    """One episode; on a table partitioned by chunk only its folder is read."""
    where = F.col("episode_index") == episode
    return frames.where(where & (F.col(PARTITION) == episode // per_chunk) if PARTITION in frames.columns else where)


def write_frames(df: DataFrame, path: str, per_chunk: int = EPISODES_A_CHUNK, mode: str = "overwrite") -> None:
    """Episodes in order, whole within a file, in folders of per_chunk episodes."""
    x = df.withColumn(PARTITION, F.floor(F.col("episode_index") / per_chunk))
    x.repartitionByRange(PARTITION, "episode_index").sortWithinPartitions(PARTITION, "episode_index", "frame_index").write.mode(mode).partitionBy(PARTITION).parquet(path)


def read_json(spark: SparkSession, path: str) -> dict:
    """One JSON document of metadata, on the driver."""
    return json.loads("\n".join(r.value for r in spark.read.option("wholetext", "true").text(path).limit(1).collect()))


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a given schema; absent keys are null, unreadable lines give rows of nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def write_lines(df: DataFrame, path: str, force: bool = False, append: bool = False) -> None:
    """JSON lines; without force nothing is written where something lies."""
    df.write.mode("append" if append else "overwrite" if force else "ignore").json(path)


def read_config(path: str) -> dict:
    """JSON or YAML by the name's ending."""
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            import yaml

            return yaml.safe_load(f)
        return json.load(f)


def nested_steps(records: DataFrame, steps: str, keep: list[str]) -> DataFrame:
    """One row per step of records that hold an array of steps, with the record's columns, length and position."""
    x = records.select(*keep, F.size(steps).alias("_len"), F.posexplode(steps).alias("_frame_index", "_s"))
    return x.select(*keep, "_len", "_frame_index", "_s.*")


#: Formats whose libraries may be missing: name -> reader(spark, path).
PLUGINS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def read_plugin(spark: SparkSession, name: str, path: str) -> DataFrame:
    if name not in PLUGINS:
        raise ValueError(f"no reader for {name}; register one in PLUGINS")
    return PLUGINS[name](spark, path)


def read_binary(spark: SparkSession, path: str, decode: Callable[[bytes], list[dict]], schema: T.StructType | str) -> DataFrame:
    """Files of any binary format through decode, a function from a file's bytes to rows; one file at a time in a worker."""
    names = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).names

    def run(batches):
        import pandas as pd

        for batch in batches:
            for content in batch["content"]:
                yield pd.DataFrame(decode(bytes(content)), columns=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


# catalogs


def column_roles(features: dict[str, str]) -> dict[str, list[str]]:
    """Columns by role, from their names' first part and type: state, action, video, annotation."""
    roles: dict[str, list[str]] = {"state": [], "action": [], "video": [], "annotation": []}
    for name, dtype in features.items():
        if dtype in ("video", "image") or name.startswith("observation.images"):
            roles["video"].append(name)
        elif name.startswith("observation.state"):
            roles["state"].append(name)
        elif name == "action" or name.startswith("action."):
            roles["action"].append(name)
        elif name.startswith("annotation."):
            roles["annotation"].append(name)
    return roles


def task_key(annotations: list[str]) -> str | None:
    """The annotation column that holds the task: the first of LANGUAGE_KEYS there is, else the first of all."""
    return next((k for k in LANGUAGE_KEYS if k in annotations), annotations[0] if annotations else None)


def parse_slices(text: str) -> dict[str, tuple[int, int]]:
    """{"name": [start, end], ...} of JSON, checked."""
    out = {}
    for name, pair in json.loads(text).items():
        if not (isinstance(pair, list) and len(pair) == 2 and all(isinstance(x, int) for x in pair) and 0 <= pair[0] < pair[1]):
            raise ValueError(f"{name}: [start, end] with 0 <= start < end expected, got {pair}")
        out[name] = (pair[0], pair[1])
    return out


def modality_catalog(features: dict[str, str], widths: dict[str, int], slices: dict[str, dict[str, tuple[int, int]]] | None = None) -> list[tuple]:
    """(modality, key, original_key, start, end): given slices of the first state and action column, else those columns whole."""
    roles, out = column_roles(features), []
    for modality in ("state", "action"):
        if not roles[modality]:
            continue
        column = roles[modality][0]
        own = (slices or {}).get(modality) or {modality: (0, widths[column])}
        for key, (a, b) in own.items():
            if b > widths[column]:
                raise ValueError(f"{modality}.{key} ends at {b}, {column} has {widths[column]}")
            out.append((modality, key, column, a, b))
    for modality in ("video", "annotation"):
        for column in roles[modality]:
            out.append((modality, column.split(".", 2)[-1] if modality == "video" else column.split(".", 1)[1], column, None, None))
    return out


def with_horizon(config: dict, horizon: int) -> dict:
    """A dataset configuration with another action horizon: the global one, those of the overrides, and every action's delta indices."""
    if horizon < 1:
        raise ValueError("horizon must be positive")
    out = copy.deepcopy(config)
    out["action_horizon"] = horizon
    for part in ("vla_override_kwargs", "action_head_override_kwargs"):
        if part in out.get("model", {}):
            out["model"][part]["action_horizon"] = horizon
    for modalities in out.get("modality_configs", {}).values():
        if "action" in modalities:
            modalities["action"]["delta_indices"] = list(range(horizon))
    return out


def with_action_dim(config: dict, dim: int) -> dict:
    """A dataset configuration with another greatest action width."""
    return {**copy.deepcopy(config), "max_action_dim": dim}


def with_overrides(config: dict) -> dict:
    """What the configuration's own overrides ask for, carried through it."""
    model = config.get("model", {})
    if "action_head_override_kwargs" in model:
        config = with_horizon(config, config["action_horizon"])
    wider = model.get("expand_action_head_kwargs", {}).get("expand_action_dim")
    return with_action_dim(config, wider["new_action_dim"]) if wider else config


def split_name(name: str) -> tuple[str, str]:
    """Modality and key of a dotted name, divided at its first dot."""
    modality, _, key = name.partition(".")
    return modality, key


def plain_names(df: DataFrame) -> DataFrame:
    """Dots in column names as double underscores."""
    return df.toDF(*[c.replace(".", "__") for c in df.columns])


# names and paths


def filtered(names: list[str], include: list | None = None, exclude: list | None = None, precedence: str = "exclude", order: str = "input") -> list[str]:
    """Names by glob patterns or functions of the name. precedence exclude: an exclusion is final; include: an inclusion is. order
    include: as the patterns come."""
    fits = lambda n, p: bool(p(n)) if callable(p) else fnmatch.fnmatchcase(n, p)
    inside = lambda n, patterns: any(fits(n, p) for p in patterns or [])
    kept = []
    for n in names:
        yes, no = include is None or inside(n, include), inside(n, exclude)
        if precedence == "include" and include is not None:
            no = no and not yes
        if yes and not no:
            kept.append(n)
    if order == "include" and include:
        kept.sort(key=lambda n: next((k for k, p in enumerate(include) if fits(n, p)), len(include)))
    return kept


def glob_column(column, pattern: str):
    """Whether a text column matches a glob pattern."""
    return column.rlike("^" + fnmatch.translate(pattern).removesuffix(r"\Z").removesuffix(r"\z") + "$")


def mixture_paths(spec: dict[str, list[str]], found: list[str], tags: set[str]) -> list[tuple[str, str]]:
    """(tag, path) of a mixture's patterns; unknown tags are refused, paths of scripts and JSON files skipped, slashes at the end ignored."""
    out = []
    for tag, patterns in spec.items():
        if tag not in tags:
            raise ValueError(f"unknown tag {tag}")
        for p in patterns:
            p = p.rstrip("/")
            hits = sorted(fnmatch.filter(found, p)) if re.search(r"[*?\[]", p) else [p]
            out += [(tag, h) for h in hits if ".sh" not in h and ".json" not in h]
    return out


def episode_of(path: str) -> int:
    """Episode number in a file's name."""
    return int(re.search(r"(\d+)$", PurePosixPath(path).stem)[1])
