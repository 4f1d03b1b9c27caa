"""Splits that keep connected episodes together, stratified by label.

Episodes are connected by tasks that are the same text (rule of llm.duplicates). Components are found on the graph of the
distinct tasks, named by the SHA-256 of their canonical text, by alternating large-star and small-star steps, each round written to
the shared folder; links and components stay distributed, and joins on popular tasks or labels go through joins.spread.

Component label vectors (episodes per dataset and outcome) are then placed by grouped iterative stratification: of the label with the
fewest outstanding episodes, counted anew after each placement, the largest group goes to the split that needs that label most. What
is placed at once is a component, where it holds at least 1 / BUNDLES of its rarest label, or else a bundle of components: those that
lie in the same of BUNDLES stretches of their rarest label's components in pseudorandom order. So one rule holds at every size; labels
with fewer episodes than BUNDLES are placed component by component.

Defined cases: null and blank tasks and the placeholder connect nothing; an episode without a real task is a component of its
own; the same episode delivered twice is one (its first row by export); a null episode_index is left out; a task that `tasks`
doesn't list connects, but a group without any listed task has a null group_task_index; empty tables give no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajecta.llm.duplicates import canonical
from trajecta.operators.joins import may_be_hot, spread
from trajecta.operators.prefix import hashed_prefix_sum
from trajecta.session import materialize

PLACEHOLDER = "not provided"
PROPORTIONS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
#: Stretches that a label's small components are bundled in: the driver places at most 2 * BUNDLES bundles a label, a label being a
#: dataset or an outcome.
BUNDLES = 128
SEED = 7


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (u, v); root is the least node of the component."""
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "p6-edges")
    state, n = None, edges.count()
    least_of = lambda e: e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = spread(both, least_of(both).withColumn("m", F.least("m", "u")), ["u"], "n", 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        if may_be_hot(n):
            large = materialize(large, "p6-large")
        least = least_of(large)
        small = spread(large, least, ["u"], "n", n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, "p6-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == state:
            break
        state, n = now, now[0]
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def episode_groups(episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """(episode_index, root, task_index) of each episode with a real task; task_index is the least that `tasks` lists for the group."""
    real = lambda c: (c != "") & (c != F.lit(PLACEHOLDER.replace(" ", "")))
    node = lambda c: F.unhex(F.sha2(c, 256))
    listed = tasks.where("task_index IS NOT NULL").select(canonical(F.col("task")).alias("c"), "task_index").where(real(F.col("c"))).groupBy(node(F.col("c")).alias("node")).agg(F.min("task_index").alias("task_index"))
    links = episodes.where("episode_index IS NOT NULL").select("episode_index", F.explode("tasks").alias("t")).select("episode_index", canonical(F.col("t")).alias("c"))
    links = materialize(links.where(real(F.col("c"))).select("episode_index", node(F.col("c")).alias("node")).distinct(), "p6-links")
    first = links.groupBy("episode_index").agg(F.min("node").alias("v"))
    roots = components(links.join(first, "episode_index").select(F.col("node").alias("u"), "v"))
    # one row a task from here on, then one a group
    nodes = links.select("node").distinct().join(roots, "node", "left").join(listed, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "task_index")
    nodes = materialize(nodes, "p6-nodes")
    least = nodes.groupBy("root").agg(F.min("task_index").alias("task_index"), F.count("*").alias("n"))
    known = spread(nodes.select("node", "root"), least, ["root"], "n", nodes.count())
    total = links.count()  # at least as many as episodes
    firsts = first.groupBy(F.col("v").alias("node")).agg(F.count("*").alias("n"))
    known = known.join(firsts, "node")
    if may_be_hot(total):
        known = materialize(known, "p6-known")
    return spread(first.withColumnRenamed("v", "node"), known, ["node"], "n", total).select("episode_index", "root", "task_index")


def groups(episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """group_task_index of each episode with a real task."""
    return episode_groups(episodes, tasks).select("episode_index", F.col("task_index").alias("group_task_index"))


def stratified(vectors: dict[str, dict[str, int]], proportions=PROPORTIONS) -> dict[str, str]:
    """The split of each group, given its counts by label: rarest outstanding label first, largest group first, into the split needing it most."""
    totals: dict[str, int] = {}
    holders: dict[str, list[str]] = {}
    for g, v in vectors.items():
        for label, n in v.items():
            totals[label] = totals.get(label, 0) + n
            holders.setdefault(label, []).append(g)
    for label, gs in holders.items():
        gs.sort(key=lambda g: (vectors[g][label], g))
    needs = [{label: p * n for label, n in totals.items()} for _, p in proportions]
    room = [p * sum(totals.values()) for _, p in proportions]
    out: dict[str, str] = {}
    rarest = [(n, label) for label, n in totals.items()]
    heapq.heapify(rarest)
    while rarest:
        n, label = heapq.heappop(rarest)
        if n != totals[label]:
            continue  # its count has changed since
        while holders[label] and holders[label][-1] in out:
            holders[label].pop()
        if not holders[label]:
            continue
        g = holders[label].pop()
        k = max(range(len(proportions)), key=lambda i: (needs[i][label], room[i], proportions[i][1]))
        out[g] = proportions[k][0]
        for x, m in vectors[g].items():
            needs[k][x] -= m
            room[k] -= m
            totals[x] -= m
            heapq.heappush(rarest, (totals[x], x))
    return out


def splits(episodes: DataFrame, tasks: DataFrame, proportions=PROPORTIONS, seed: int = SEED) -> DataFrame:
    """episode_index, split and component of every episode."""
    return _splits(episodes, tasks, proportions, seed).select("episode_index", "split", "component")


def _splits(episodes: DataFrame, tasks: DataFrame, proportions, seed: int) -> DataFrame:
    newest = Window.partitionBy("episode_index").orderBy("exported_at", F.xxhash64("dataset_path", "success"))
    rows = episodes.where("episode_index IS NOT NULL").withColumn("_n", F.row_number().over(newest)).where("_n = 1")
    rows = rows.select("episode_index", F.concat(F.lit("dataset "), F.coalesce("dataset_path", F.lit(""))).alias("_d"), F.concat(F.lit("success "), F.coalesce(F.col("success").cast("string"), F.lit(""))).alias("_s"))
    groups_ = episode_groups(episodes, tasks).select("episode_index", "root")
    rows = materialize(rows.join(groups_, "episode_index", "left").withColumn("component", F.coalesce(F.hex("root"), F.concat(F.lit("e"), F.col("episode_index").cast("string")))).drop("root"), "p6-rows")

    vectors = materialize(rows.select("component", F.explode(F.array("_d", "_s")).alias("label")).groupBy("component", "label").agg(F.count("*").alias("n")), "p6-vectors")
    totals = vectors.groupBy("label").agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    # rarest label of each component, its count there, and the component's episodes (each counts under two labels)
    ranked = spread(vectors, totals, ["label"], "k", vectors.count())
    primary = ranked.groupBy("component").agg(F.min(F.struct("total", "label", "n")).alias("p"), (F.sum("n") / 2).cast("long").alias("size"))
    primary = primary.select("component", F.col("p.label").alias("primary"), F.col("p.total").alias("total"), F.col("p.n").alias("own"), "size")
    ordered = hashed_prefix_sum(primary, ["primary"], "component", F.col("own"), seed, "before")
    alone = F.col("own") * BUNDLES >= F.col("total")
    bundle = F.when(alone, F.concat(F.lit("c "), "component")).otherwise(F.concat(F.lit("b "), F.floor(F.col("before") * BUNDLES / F.col("total")).cast("string"), F.lit(" "), "primary"))
    placing = materialize(ordered.select("component", "size", bundle.alias("bundle")), "p6-placing")
    held: dict[str, dict[str, int]] = {}
    for r in vectors.join(placing, "component").groupBy("bundle", "label").agg(F.sum("n").alias("n")).collect():  # at most 2 * BUNDLES bundles a label
        held.setdefault(r["bundle"], {})[r["label"]] = r["n"]
    chosen = rows.sparkSession.createDataFrame(list(stratified(held, proportions).items()), "bundle string, split string")
    by_component = placing.join(chosen, "bundle").select("component", "split", "size")
    return spread(rows, by_component, ["component"], "size", rows.count())


def shares(episodes: DataFrame, tasks: DataFrame, proportions=PROPORTIONS, seed: int = SEED) -> DataFrame:
    """Of each label (and of all episodes, label "all") and split: episodes, share reached, target share, and the largest component's
    episodes with the label, which no placement can divide."""
    spark = episodes.sparkSession
    got = materialize(_splits(episodes, tasks, proportions, seed), "p6-splits")
    x = got.select("component", "split", F.explode(F.array(F.lit("all"), "_d", "_s")).alias("label")).groupBy("component", "split", "label").agg(F.count("*").alias("n"))
    x = x.groupBy("label", "split").agg(F.sum("n").alias("n"), F.max("n").alias("largest"))
    target = spark.createDataFrame([(k, float(p)) for k, p in proportions], "split string, target_share double")
    grid = x.groupBy("label").agg(F.sum("n").alias("total"), F.max("largest").alias("largest_component")).crossJoin(F.broadcast(target))  # a row a label and split
    out = grid.join(x.drop("largest"), ["label", "split"], "left").na.fill(0, ["n"])
    return out.select("label", "split", "n", (F.col("n") / F.col("total")).alias("share"), "target_share", "largest_component")
