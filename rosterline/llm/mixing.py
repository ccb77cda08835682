"""Mixing sources to target weights: a token budget spread down a tree of domain, language and source.

At each node the budget is shared among the children by weight. A child that has fewer tokens than its share (all
of its epochs counted) gives the rest to its siblings, by weight again; only what no sibling can use is left to
siblings of the parent, since a node is never given more than its subtree holds. With children in ascending order of
tokens per weight, the level that all unsaturated ones reach is the maximum over i of
(budget - tokens of those before i) / (weight of i and those after).

Each leaf then yields whole epochs of its documents and the longest token prefix of one more epoch that fits. The
order of an epoch is that of md5(seed:epoch:doc_id). A leaf's cut is found in two steps, so no leaf is ever sorted
in one task: token sums by the leading digits of the hash give the range in which the cut lies, and only
documents of that range are ranked. Selection itself compares each document with its leaf's cut: texts are not
shuffled.

Rows: NULL and blank texts hold no tokens and are never chosen; NULL levels are read as ``unknown``; a NULL doc_id is
ordered like the text ``null``; rows that repeat a doc_id stand and fall together; a weight that is NULL or not
positive excludes its node; an empty table gives no rows. All columns of the documents are kept, whatever their
names; ``epoch`` is added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterline.llm.common import prepare, staged

SEED = "mix-1"
RANGE_DIGITS = 3
BLANK_PARTED = "[^ \\t\\n\\x0B\\f\\r]+"


@dataclass(frozen=True)
class Level:
    """One level of the tree: the SQL expression of a document's node, and that of the node's weight."""

    name: str
    node: str
    weight: str


# The tree and target weights of the registered query.
LEVELS = (
    Level("domain", "CASE WHEN source = 'src0' THEN 'crawl' WHEN length(source) = 4 THEN 'curated' ELSE 'reference' END",
          "CASE domain WHEN 'crawl' THEN 0.5 WHEN 'curated' THEN 0.3 ELSE 0.2 END"),
    Level("language", "lang", "CASE language WHEN 'en' THEN 0.5 WHEN 'de' THEN 0.2 WHEN 'fr' THEN 0.2 ELSE 0.1 END"),
    Level("origin", "source", "CASE WHEN origin IN ('src1', 'src11') THEN 2.0 ELSE 1.0 END"),
)
BUDGET_SHARE = 0.8
EPOCHS = 2


def token_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(BLANK_PARTED)), F.lit(0)).cast("long")


def _node(i: int) -> str:
    return f"__node{i}"


def _leaf_columns(levels: tuple[Level, ...]) -> list[Column]:
    return [F.coalesce(F.expr(level.node).cast("string"), F.lit("unknown")).alias(_node(i)) for i, level in enumerate(levels)]


def _key(epoch: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def quotas(leaves: DataFrame, levels: tuple[Level, ...], share: float, epochs: int) -> DataFrame:
    """Leaves (node columns, ``tokens``) with the tokens each shall give, as ``quota``."""
    nodes = [_node(i) for i in range(len(levels))]
    budget = F.lit(float(leaves.agg(F.sum("tokens")).first()[0] or 0) * share)
    budgets, parents = None, []
    for i, level in enumerate(levels):
        named = {other.name: F.col(nodes[k]) for k, other in enumerate(levels[: i + 1])}
        held = leaves.groupBy(*nodes[: i + 1]).agg((F.sum("tokens") * F.lit(epochs)).cast("double").alias("held"))
        weighted = held.withColumns(named).withColumn("weight", F.expr(level.weight).cast("double")).drop(*named)
        weighted = weighted.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(0.0)))
        joined = weighted.withColumn("budget", budget) if budgets is None else weighted.join(budgets, parents)
        by_need = Window.partitionBy(*parents).orderBy(F.expr("CASE WHEN weight > 0 THEN held / weight END").asc_nulls_last(), nodes[i])
        before = by_need.rowsBetween(Window.unboundedPreceding, -1)
        rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        level_of = (F.col("budget") - F.coalesce(F.sum("held").over(before), F.lit(0.0))) / F.nullif(F.sum("weight").over(rest), F.lit(0.0))
        filled = joined.withColumn("reach", F.when(F.col("weight") > 0, level_of))
        filled = filled.withColumn("reach", F.max("reach").over(Window.partitionBy(*parents)))
        filled = filled.withColumn("budget", F.greatest(F.lit(0.0), F.least("held", F.col("weight") * F.coalesce("reach", F.lit(0.0)))))
        parents = nodes[: i + 1]
        budgets = filled.select(*parents, "budget")
    return leaves.join(budgets.withColumnRenamed("budget", "quota"), nodes)


def cuts(tokens: DataFrame, levels: tuple[Level, ...], share: float, epochs: int, seed: str) -> DataFrame:
    """Per leaf: its quota, its whole epochs, and the last hash of the part epoch (NULL if that is empty).

    ``tokens`` has node columns, doc_id and n_tokens, and no row without tokens.
    """
    nodes = [_node(i) for i in range(len(levels))]
    leaves = staged(tokens.groupBy(*nodes).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    plan = quotas(leaves, levels, share, epochs).withColumn("whole", F.floor(F.col("quota") / F.col("tokens")))
    plan = staged(plan.withColumn("left", F.col("quota") - F.col("whole") * F.col("tokens")), "mix-quotas")
    keyed = tokens.join(plan.where("left > 0").select(*nodes, "whole", "left"), nodes).withColumn("key", _key(F.col("whole"), seed))
    keyed = keyed.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    up_to = Window.partitionBy(*nodes).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = keyed.groupBy(*nodes, "range", "left").agg(F.sum("n_tokens").alias("inside")).withColumn("total", F.sum("inside").over(up_to))
    fits = ranges.where("total <= left").groupBy(*nodes).agg(F.max("range").alias("last"))
    cut = ranges.where("total > left").groupBy(*nodes).agg(F.min(F.struct("range", (F.col("total") - F.col("inside")).alias("base"))).alias("cut"))
    cut = staged(cut.select(*nodes, F.col("cut.range").alias("range"), F.col("cut.base").alias("base")), "mix-ranges")
    inner = keyed.join(cut, [*nodes, "range"])
    in_order = Window.partitionBy(*nodes, "range").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inner = inner.withColumn("total", F.col("base") + F.sum("n_tokens").over(in_order)).where("total <= left")
    last = inner.groupBy(*nodes).agg(F.max("key").alias("last_key"))
    # "g" sorts after every hexadecimal digit: a range that fits takes all of its hashes.
    found = plan.join(fits, nodes, "left").join(last, nodes, "left")
    found = found.withColumn("last_key", F.coalesce("last_key", F.concat("last", F.lit("g"))))
    return staged(found.select(*nodes, "tokens", "quota", F.col("whole").cast("int").alias("whole"), "last_key"), "mix-cuts")


def mixed(
    docs: DataFrame, levels: tuple[Level, ...] = LEVELS, share: float = BUDGET_SHARE, epochs: int = EPOCHS, seed: str = SEED
) -> DataFrame:
    """The chosen documents, one row for each epoch in which one is chosen, with that ``epoch``.

    The budget is ``share`` of all tokens; no document is chosen more than ``epochs`` times.
    """
    prepare(docs.sparkSession)
    nodes = [_node(i) for i in range(len(levels))]
    tokens = staged(docs.select(*_leaf_columns(levels), "doc_id", token_count().alias("n_tokens")).where("n_tokens > 0"), "mix-tokens")
    leaf = cuts(tokens, levels, share, epochs, seed).select(*nodes, F.col("whole").alias("__whole"), F.col("last_key").alias("__last_key"))
    # One row per leaf, read from a written table: the optimizer knows its size before it plans the join.
    placed = docs.select("*", *_leaf_columns(levels)).where(F.col("text").rlike(BLANK_PARTED)).join(leaf, nodes)
    more = F.coalesce((_key(F.col("__whole"), seed) <= F.col("__last_key")).cast("int"), F.lit(0))
    times = F.col("__whole") + more
    chosen = placed.withColumn("__times", times).where("__times > 0")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "epoch"]
    return chosen.select(*kept, *nodes, F.explode(F.sequence(F.lit(0), F.col("__times") - 1)).alias("epoch"))


def mix_documents(docs: DataFrame, levels: tuple[Level, ...] = LEVELS, share: float = BUDGET_SHARE, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """As ``mixed``, with the columns of the documents only."""
    return mixed(docs, levels, share, epochs, seed).select(*docs.columns)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = [F.col(_node(i)).alias(level.name) for i, level in enumerate(LEVELS)]
    return chosen.select("doc_id", *names, "epoch", token_count().alias("n_tokens"))


def _fill_sql(i: int) -> str:
    """One level of the tree in SQL: budgets of the nodes of level i from those of their parents."""
    nodes = ", ".join(f"n{k}" for k in range(i + 1))
    parents = ", ".join(f"n{k}" for k in range(i))
    weight = LEVELS[i].weight
    for k, level in enumerate(LEVELS):
        weight = weight.replace(level.name, f"n{k}") if k <= i else weight
    over = f"PARTITION BY {parents} " if parents else ""
    join = f"JOIN b{i - 1} USING ({parents})" if parents else "CROSS JOIN (SELECT CAST(sum(tokens) AS DOUBLE) * CAST({share} AS DOUBLE) AS budget FROM leaves)"
    return f"""h{i} AS (SELECT {nodes}, CAST(sum(tokens) * {{epochs}} AS DOUBLE) AS held, CAST({weight} AS DOUBLE) AS weight FROM leaves GROUP BY {nodes}),
r{i} AS (SELECT {nodes}, held, weight, (budget - coalesce(sum(held) OVER ({over}ORDER BY held / weight, n{i} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER ({over}ORDER BY held / weight, n{i} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reach FROM h{i} {join}),
b{i} AS (SELECT {nodes}, greatest(0, least(held, weight * max(reach) OVER ({over.strip()}))) AS budget FROM r{i})"""


def oracle(share: float = BUDGET_SHARE, epochs: int = EPOCHS, seed: str = SEED) -> str:
    nodes = [f"coalesce(CAST({level.node} AS VARCHAR), 'unknown') AS n{i}" for i, level in enumerate(LEVELS)]
    names = ", ".join(f"n{i}" for i in range(len(LEVELS)))
    fills = ",\n".join(_fill_sql(i) for i in range(len(LEVELS))).format(share=share, epochs=epochs)
    return f"""WITH docs AS (SELECT doc_id, {", ".join(nodes)}, len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS n_tokens FROM documents),
used AS (SELECT * FROM docs WHERE n_tokens > 0),
leaves AS (SELECT {names}, sum(n_tokens) AS tokens FROM used GROUP BY {names}),
{fills},
plan AS (SELECT *, floor(budget / tokens) AS whole, budget - floor(budget / tokens) * tokens AS rest FROM leaves JOIN b{len(LEVELS) - 1} USING ({names})),
ranked AS (SELECT doc_id, {names}, n_tokens, whole, rest, sum(n_tokens) OVER (PARTITION BY {names} ORDER BY md5('{seed}:' || CAST(CAST(whole AS BIGINT) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR))) AS total
  FROM used JOIN plan USING ({names})),
times AS (SELECT *, CAST(whole AS BIGINT) + CASE WHEN rest > 0 AND total <= rest THEN 1 ELSE 0 END AS n FROM ranked)
SELECT doc_id, {", ".join(f"n{i} AS {level.name}" for i, level in enumerate(LEVELS))}, CAST(unnest(range(n)) AS INTEGER) AS epoch, CAST(n_tokens AS BIGINT) AS n_tokens FROM times"""


ORACLE_SQL = oracle()
