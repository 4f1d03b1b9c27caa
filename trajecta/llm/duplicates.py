"""Records that are the same but for case, white space, punctuation or slot order.

Rows equal byte for byte are collapsed first, with their counts; only the distinct texts left are brought to canonical form
(letters and digits in order, case removed), and those are grouped again on the whole canonical text, the counts summed.
No list of a group's records is ever built: each record finds the smallest id of its set by a join on its raw text, in which popular
texts and sets are spread over all tasks (joins.spread).

Defined cases: texts without letter or digit (null, blank, punctuation) are no record; of several slots those are ignored;
the same id delivered twice is one record; a null id names no record; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajecta.operators.joins import spread
from trajecta.session import materialize

#: Everything but Unicode letters (L) and digits (N).
OTHER = r"[^\p{L}\p{N}]+"
#: Between slots of a canonical record; no letter or digit, so it can't come from a text.
BETWEEN = "\u0001"


def canonical(text: Column) -> Column:
    """Letters and digits without case; upper before lower also levels letters with several small forms (the optimizer would
    drop an upper directly within lower)."""
    return F.lower(F.regexp_replace(F.upper(text), OTHER, ""))


def canonical_record(slots: list[Column]) -> Column:
    """Canonical slots in sorted order without empty ones, null if none is left."""
    kept = F.filter(F.array(*[canonical(s) for s in slots]), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, F.array_join(F.array_sort(kept), BETWEEN))


def _stages(df: DataFrame, id_col: str, slots: list[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct (id, raw slots) with their deliveries; distinct raw slots with canonical text, smallest id and counts."""
    raw = [f"_s{k}" for k in range(len(slots))]
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), *[F.coalesce(F.col(s), F.lit("")).alias(r) for s, r in zip(slots, raw)])
    records = rows.groupBy("_id", *raw).agg(F.count("*").alias("_rows"))
    texts = records.groupBy(*raw).agg(F.min("_id").alias("_least"), F.count("*").alias("_records"), F.sum("_rows").alias("_rows"))
    texts = texts.withColumn("_canonical", canonical_record([F.col(r) for r in raw])).where("_canonical IS NOT NULL")
    return records, texts


def collapsed(df: DataFrame, id_col: str, slots: list[str]) -> DataFrame:
    """One row per set of same records: keep_id, its canonical text, how many records and delivered rows it has."""
    _, texts = _stages(df, id_col, slots)
    sums = texts.groupBy("_canonical").agg(F.min("_least").alias("keep_id"), F.sum("_records").alias("n_records"), F.sum("_rows").alias("n_rows"))
    return sums.select("keep_id", F.col("_canonical").alias("canonical"), "n_records", "n_rows")


def copies(df: DataFrame, id_col: str, slots: list[str]) -> DataFrame:
    """(keep_id, copy_id) of each record that isn't the one kept of its set."""
    records, texts = _stages(df, id_col, slots)
    raw = [c for c in records.columns if c.startswith("_s")]
    texts = materialize(texts, "p2-texts")
    n_texts, n_records = texts.agg(F.count("*"), F.coalesce(F.sum("_records"), F.lit(0))).head()
    sets = texts.groupBy("_canonical").agg(F.min("_least").alias("keep_id"), F.sum("_records").alias("_n"), F.count("*").alias("_forms")).where("_n > 1").drop("_n")
    keep = spread(texts, sets, ["_canonical"], "_forms", n_texts).select(*raw, "keep_id", "_records")
    pairs = spread(records.drop("_rows"), keep, raw, "_records", n_records).where("_id <> keep_id").select("keep_id", F.col("_id").alias("copy_id"))
    return pairs.distinct()
