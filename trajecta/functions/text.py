"""Text functions on built-in expressions, with a pandas UDF where Spark has none."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Markers that flag a text's origin.
MARKERS = {"lapa": "<LAPA>", "dream": "<DREAM>", "cotrain": "<COTRAIN>"}
#: White space as Python's \s has it, as a class that Java and RE2 read alike.
SPACES = r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
NOT_WORDS = rf"[^\p{{L}}\p{{N}}_{SPACES}]"


def formalized(x: Column) -> Column:
    """Lower case without anything but letters, digits, underscores and white space, all of Unicode (combining marks go); null stays null."""
    return F.regexp_replace(F.lower(x), NOT_WORDS, "")


def single_spaced(x: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def without_prefix(x: Column, mark: str = ": ") -> Column:
    """What follows the last mark; the whole text without one."""
    return F.substring_index(x, mark, -1)


def marker_flags(x: Column) -> dict[str, Column]:
    return {name: x.contains(mark) for name, mark in MARKERS.items()}


def without_markers(x: Column) -> Column:
    for mark in MARKERS.values():
        x = F.replace(x, F.lit(mark), F.lit(""))
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def chosen(texts: Column, key: Column, default: str, seed: int = 0, dropout: float = 0.0, training: bool = True, spread: Column | None = None, constant: bool = False) -> Column:
    """One of an array's texts. In training, rows where spread holds (all, without it) take one by a hash of key and the share dropout
    of keys gets the default; all others take the first. The default also stands for an empty array, and for all texts if constant."""
    if constant:
        return F.lit(default)
    first = F.get(texts, F.lit(0))
    if not training:
        return F.when(F.size(texts) > 0, first).otherwise(F.lit(default))
    u = lambda what: uniform(F.concat_ws(",", key, F.lit(seed), F.lit(what)))
    by_hash = F.get(texts, F.floor(u("key") * F.size(texts)).cast("int"))
    one = by_hash if spread is None else F.when(spread, by_hash).otherwise(first)
    return F.when(F.coalesce(F.size(texts) < 1, F.lit(True)) | (u("dropout") < dropout), F.lit(default)).otherwise(one)


#: A list literal whose first element is quoted (groups 1 and 2: what is within single and double quotes), or is a bare word (3).
_LITERAL = r"""^\s*\[\s*(?:'((?:[^'\\]|\\.)*+)'|"((?:[^"\\]|\\.)*+)"|([^'"\[\],\s]++))\s*(?:,.*)?\]\s*$"""


def first_of_literal(x: Column) -> Column:
    """A text that is a list literal stands for its first element, quotes of either kind and escapes within them read as such."""
    pattern = "(?s)" + _LITERAL
    inside = F.concat(*[F.regexp_extract(x, pattern, k) for k in (1, 2, 3)])
    return F.when(x.rlike(pattern), F.regexp_replace(inside, r"\\(['\"\\])", "$1")).otherwise(x)


def prompt(tag: Column, x: Column, templates: dict[str, str], default: str | None = None) -> Column:
    """Template of the tag with the text in place of {}; an unknown tag is an error unless there is a default."""
    out = F.raise_error(F.concat(F.lit("no template for "), tag)) if default is None else _filled(default, x)
    for name, template in templates.items():
        out = F.when(tag == name, _filled(template, x)).otherwise(out)
    return out


def _filled(template: str, x: Column) -> Column:
    before, _, after = template.partition("{}")
    return F.concat(F.lit(before), x, F.lit(after))


def task_instruction(name_en: Column, name: Column, scene: Column) -> Column:
    """name.scene, the English name where there is one."""
    known = F.coalesce(F.nullif(F.trim(name_en), F.lit("")), F.nullif(F.trim(name), F.lit("")), F.lit("Unknown Task"))
    return F.concat_ws(".", known, F.nullif(F.trim(scene), F.lit("")))


def episode_path(episode: Column, per_chunk: int = 1000) -> Column:
    return F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(episode / per_chunk), episode)


def json_or_empty(x: Column, schema: str) -> Column:
    """A JSON text as struct; fields are null where it can't be read."""
    return F.from_json(x, schema, {"mode": "PERMISSIVE"})


def rate(x: Column) -> Column:
    """Frames per second of "30/1" or "29.97"; null for a zero divisor or no number."""
    parts = F.split(x, "/")
    low = F.coalesce(F.try_to_number(F.get(parts, F.lit(1)), F.lit("999999")).cast("double"), F.lit(1.0))
    high = F.get(parts, F.lit(0)).try_cast("double")
    return F.when(low != 0, high / low)


def frame_estimate(frames: Column, duration: Column, fps: Column) -> Column:
    """Frames of a probe, or where it counts none, those that fit into the duration."""
    n = F.coalesce(frames, F.lit(0)).cast("long")
    return F.when((n == 0) & (duration > 0), F.floor(duration * fps).cast("long")).otherwise(n)


#: The signs of thousands, a blank for none.
SIGNS = (" ", "K", "M", "B", "T")


def readable_count(n: Column) -> Column:
    """1234567 as "1.23 M": whole thousands cut, two digits of the rest where that is above a hundredth."""
    digits = F.length(F.floor(n).cast("long").cast("string"))
    group = F.least(F.ceil(digits / 3), F.lit(len(SIGNS))).cast("int")
    factor = F.element_at(F.array(*[F.lit(10.0 ** (-3 * k)) for k in range(len(SIGNS))]), group)
    v = n * factor
    rest = v - F.floor(v)
    decimals = F.when(rest > 0.01, F.regexp_replace(F.format_string("%.2f", rest), "^0+", "")).otherwise("")
    return F.concat(F.format_number(F.floor(v), 0), decimals, F.lit(" "), F.element_at(F.array(*[F.lit(k) for k in SIGNS]), group))


def scientific(x: Column, digits: int = 1, capital: bool = False) -> Column:
    """0.0015 as "1.5e-3"; 0 as "0"."""
    return F.when(x == 0, "0").otherwise(F.regexp_replace(F.format_string(f"%.{digits}e", x.cast("double")), "e-0", "E-" if capital else "e-"))


def low_hash(x: Column) -> Column:
    """The low 128 bits of SHA-256, as hexadecimal."""
    return F.substring(F.sha2(x.cast("string"), 256), 33, 32)


def uniform(x: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of SHA-256."""
    return F.conv(F.substring(F.sha2(x.cast("string"), 256), 1, 13), 16, 10).cast("double") / float(16**13)


@F.pandas_udf(StringType())
def html_unescaped(x: pd.Series) -> pd.Series:
    """HTML entities resolved twice, ends stripped."""
    return x.map(lambda t: None if t is None else html.unescape(html.unescape(t)).strip())


def white_space_words(x: Column) -> Column:
    """All words of a text between white space; none of a null."""
    return F.filter(F.split(F.coalesce(x, F.lit("")), r"\s+"), lambda w: w != "")


def white_space_tokens(x: Column, width: int) -> tuple[Column, Column]:
    """The first width words, padded with empty strings, and the mask of real ones."""
    tokens = F.slice(F.concat(white_space_words(x), F.array_repeat(F.lit(""), width)), 1, width)
    return tokens, F.transform(tokens, lambda w: w != "")


def decoded(tokens: Column) -> Column:
    """The text of white-space tokens, padding left out, words one space apart."""
    return F.array_join(F.filter(tokens, lambda w: w != ""), " ")
