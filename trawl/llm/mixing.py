"""Mixing sources to target weights by hierarchical budgeting.

The documents' level columns (domain, language, source, ...) span a tree.  A
token budget is passed down it: each node's budget is split among its
children in proportion to their weights, and no child gets more than its
subtree can give (its tokens times ``max_epochs``).  What a child cannot
take goes to its siblings first, again by weight; only what a whole
family cannot take shows up one level higher, because a parent is itself
capped at the sum of its children.  A level without targets uses its nodes'
own tokens as weights; a value that a level's targets leave out has weight 1.

A leaf with quota q and t tokens gives ``q div t`` whole epochs and then a
token-prefix of the next epoch, whose order is a seeded hash of the id
(another order for every epoch): the longest prefix of at most the
remaining tokens.  Rows with one id have one place in the order and go together.

All of it runs on one row per node.  A leaf's prefix is found from the
sums of ``BUCKETS`` ranges of its order, and only the range that holds the
cut is ordered row by row, so a leaf with a third of all rows
is never sorted, nor gathered in one task.

Cases: a null level value is the value ``(none)``; null or empty text has no
tokens and such rows are never drawn; a leaf without tokens has no
capacity; a budget beyond all capacity draws every epoch of everything; null
ids have the order key of the word null; an empty table gives an
empty result; columns named ``tokens`` or ``copies`` are replaced, all
others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm import common

NONE = "(none)"
WORD = r"[^\x20\x09-\x0D]"
BUCKET_DIGITS = 3              # hex digits of the order key that name its range
BROADCAST_LEAVES = 100_000


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD}+")), F.lit(0)).cast("bigint")


def order_key(id_col: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(id_col.cast("string"), F.lit("null"))))


def _split(nodes: DataFrame, parents: list[str], level: str, targets: dict[str, float] | None) -> DataFrame:
    """Budget of each child from its parent's ``budget``, its weight and its ``capacity``.

    With children in ascending order of capacity per weight, the level to
    which the unfilled ones rise is the largest of what would remain per weight
    if all before a child were filled.
    """
    if targets is None:
        weight = F.col("tokens").cast("double")
    else:
        weight = F.lit(1.0)
        for value, w in targets.items():
            weight = F.when(F.col(level) == value, F.lit(float(w))).otherwise(weight)
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.col("capacity") / F.col("weight"), level)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    weighted = nodes.withColumn("weight", weight).where("weight > 0 and capacity > 0")
    rising = weighted.withColumn("level", (F.col("budget") - before) / behind)
    return rising.withColumn("budget", F.least("capacity", F.max("level").over(family) * F.col("weight"))).drop("weight", "level")


def budgets(facts: DataFrame, levels: list[str], targets: dict[str, dict[str, float] | None],
            budget_share: float = 1.0, max_epochs: int = 2) -> DataFrame:
    """Per leaf: the levels, ``tokens``, ``quota``, ``epochs`` (whole ones) and ``rest``.

    The budget is ``budget_share`` of all tokens.
    """
    leaves = common.written(facts.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    above = None
    for depth, level in enumerate(levels):
        path = levels[:depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("tokens").alias("tokens")).withColumn(
            "capacity", F.col("tokens") * F.lit(float(max_epochs)))
        if above is None:
            every = Window.partitionBy(F.lit(0))                # the few nodes below the root
            nodes = nodes.withColumn("budget", F.sum("tokens").over(every).cast("double") * budget_share)
        else:
            nodes = nodes.join(above.select(*levels[:depth], "budget"), levels[:depth])
        above = _split(nodes, levels[:depth], level, targets.get(level))
    quota = F.floor(F.col("budget") + 1e-6).cast("bigint")
    return above.select(*levels, "tokens", quota.alias("quota")).select(
        "*", F.floor(F.col("quota") / F.col("tokens")).cast("bigint").alias("epochs")).withColumn(
        "rest", F.col("quota") - F.col("epochs") * F.col("tokens"))


def cuts(facts: DataFrame, plan: DataFrame, levels: list[str], seed: int) -> DataFrame:
    """``plan`` with ``cut``: the last order key that the leaf's last epoch still takes."""
    small = plan.select(*levels, "epochs", "rest")
    keyed = facts.where("tokens > 0").join(_sized(small), levels).withColumn(
        "key", order_key(F.col("id"), F.col("epochs") + 1, seed)).withColumn("range", F.substring("key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy(*levels, "range").agg(F.sum("tokens").alias("sum"), F.first("rest").alias("rest"))
    order = Window.partitionBy(*levels).orderBy("range")
    upto = sums.withColumn("upto", F.sum("sum").over(order))
    # The range in which the running sum passes the rest; none if all fits.
    at = common.written(upto.where("upto > rest and upto - sum <= rest").select(
        *levels, "range", (F.col("upto") - F.col("sum")).alias("before")), "mix-ranges")
    inside = keyed.join(_sized(at), [*levels, "range"])
    run = F.col("before") + F.sum("tokens").over(Window.partitionBy(*levels).orderBy("key"))
    last = inside.withColumn("run", run).where("run <= rest").groupBy(*levels).agg(F.max("key").alias("last"))
    # Every key of the ranges before is below the range's own name.
    cut = at.join(last, levels, "left").select(*levels, F.coalesce("last", "range").alias("cut"))
    return plan.join(cut, levels, "left")


def _sized(leaves: DataFrame) -> DataFrame:
    """Broadcast one row per leaf while that is small; a shuffle join beyond."""
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def _planned(docs: DataFrame, levels: dict[str, Column], targets: dict[str, dict[str, float] | None], budget_share: float,
             max_epochs: int, seed: int, id_col: str, counted: Column) -> tuple[list[str], list[Column], DataFrame, DataFrame]:
    """Names and values of the level columns, the facts (id, levels, tokens) of every row, and the leaves' plan with its cuts."""
    names = [common.free_name(docs, f"_level{i}") for i in range(len(levels))]
    values = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in zip(names, levels.values(), strict=True)]
    facts = common.written(docs.select(F.col(id_col).alias("id"), *values, counted.alias("tokens")), "mix-facts")
    plan = budgets(facts, names, dict(zip(names, [targets.get(x) for x in levels], strict=True)), budget_share, max_epochs)
    plan = common.written(plan, "mix-plan")
    return names, values, facts, common.written(cuts(facts, plan, names, seed), "mix-cuts")


def _copies(id_col: Column, epochs: Column, rest: Column, cut: Column, seed: int) -> Column:
    """Epochs that a row is drawn in."""
    more = (rest > 0) & (cut.isNull() | (order_key(id_col, epochs + 1, seed) <= cut))
    return epochs + more.cast("bigint")


def draw(docs: DataFrame, levels: dict[str, Column], targets: dict[str, dict[str, float] | None],
         budget_share: float = 1.0, max_epochs: int = 2, seed: int = 17, id_col: str = "doc_id",
         text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """Id, levels, ``tokens`` and ``copies`` of the drawn rows of :func:`mix`, without their other columns.

    The texts are read and counted once.
    """
    counted = tokens if tokens is not None else token_count(F.col(text_col))
    names, _, facts, plan = _planned(docs, levels, targets, budget_share, max_epochs, seed, id_col, counted)
    drawn = facts.where("tokens > 0").join(_sized(plan.drop("tokens", "quota")), names).withColumn(
        "copies", _copies(F.col("id"), F.col("epochs"), F.col("rest"), F.col("cut"), seed)).where("copies > 0")
    return drawn.select(F.col("id").alias(id_col), *[F.col(n).alias(level) for n, level in zip(names, levels, strict=True)], "tokens", "copies")


def mix(docs: DataFrame, levels: dict[str, Column], targets: dict[str, dict[str, float] | None],
        budget_share: float = 1.0, max_epochs: int = 2, seed: int = 17, id_col: str = "doc_id",
        text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """The drawn rows of ``docs`` with ``tokens`` and ``copies`` (epochs drawn) added or replaced.

    ``levels`` names the tree's levels from the root down, each with the
    expression that gives a row's value.  Words are counted again only where ``tokens`` is read.
    """
    counted = tokens if tokens is not None else token_count(F.col(text_col))
    some = tokens > 0 if tokens is not None else F.col(text_col).rlike(WORD)
    names, values, _, plan = _planned(docs, levels, targets, budget_share, max_epochs, seed, id_col, counted)
    epochs, rest, cut, copies = (common.free_name(docs, f"_{x}") for x in ("epochs", "rest", "cut", "copies"))
    plan = plan.select(*names, F.col("epochs").alias(epochs), F.col("rest").alias(rest), F.col("cut").alias(cut))
    drawn = docs.select("*", *values).where(some).join(_sized(plan), names)
    own = [c for c in docs.columns if c not in ("tokens", "copies")]
    return (drawn.withColumn(copies, _copies(F.col(id_col), F.col(epochs), F.col(rest), F.col(cut), seed)).where(F.col(copies) > 0)
            .select(*own, counted.alias("tokens"), F.col(copies).alias("copies")))


# Production parameters of the registered query and of the pipeline.
LANG_TARGETS = {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}
DOMAIN_TARGETS = {"domain0": 3.0, "domain1": 2.0, "domain2": 2.0, "domain3": 1.0}


def document_levels() -> dict[str, Column]:
    """Domain (sources by the remainder of their number), language, source."""
    number = F.regexp_extract("source", r"([0-9]+)$", 1).try_cast("int")
    return {"domain": F.concat(F.lit("domain"), (number % 4).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


ORACLE_SQL = r"""
WITH facts AS (
  SELECT doc_id, coalesce('domain' || (nullif(regexp_extract(source, '([0-9]+)$', 1), '')::INT % 4)::VARCHAR, '(none)') AS domain,
    coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM facts GROUP BY ALL
), d0 AS (
  SELECT domain, sum(tokens)::DOUBLE * 2 AS capacity, (SELECT sum(tokens)::DOUBLE FROM leaves) AS budget,
    CASE domain WHEN 'domain0' THEN 3.0 WHEN 'domain1' THEN 2.0 WHEN 'domain2' THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM leaves GROUP BY domain HAVING sum(tokens) > 0
), d1 AS (
  SELECT *, (budget - coalesce(sum(capacity) OVER (ORDER BY capacity / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY capacity / weight, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rise FROM d0
), d AS (
  SELECT domain, least(capacity, max(rise) OVER () * weight) AS budget FROM d1
), l0 AS (
  SELECT domain, lang, sum(tokens)::DOUBLE * 2 AS capacity, d.budget,
    CASE lang WHEN 'en' THEN 5.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM leaves JOIN d USING (domain) GROUP BY domain, lang, d.budget HAVING sum(tokens) > 0
), l1 AS (
  SELECT *, (budget - coalesce(sum(capacity) OVER (PARTITION BY domain ORDER BY capacity / weight, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (PARTITION BY domain ORDER BY capacity / weight, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rise FROM l0
), l AS (
  SELECT domain, lang, least(capacity, max(rise) OVER (PARTITION BY domain) * weight) AS budget FROM l1
), s0 AS (
  SELECT domain, lang, source, tokens, tokens::DOUBLE * 2 AS capacity, l.budget, tokens::DOUBLE AS weight
  FROM leaves JOIN l USING (domain, lang) WHERE tokens > 0
), s1 AS (
  SELECT *, (budget - coalesce(sum(capacity) OVER (PARTITION BY domain, lang ORDER BY capacity / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (PARTITION BY domain, lang ORDER BY capacity / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rise FROM s0
), plan AS (
  SELECT domain, lang, source, quota, quota // tokens AS epochs, quota - tokens * (quota // tokens) AS rest
  FROM (SELECT domain, lang, source, tokens,
          floor(least(capacity, max(rise) OVER (PARTITION BY domain, lang) * weight) + 1e-6)::BIGINT AS quota FROM s1)
), keyed AS (
  SELECT f.*, epochs, rest, md5('17:' || (epochs + 1)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM facts f JOIN plan USING (domain, lang, source) WHERE tokens > 0
), drawn AS (
  SELECT *, epochs + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) <= rest THEN 1 ELSE 0 END AS copies
  FROM keyed
)
SELECT doc_id, domain, lang, source, tokens, copies::BIGINT AS copies FROM drawn WHERE copies > 0
"""
