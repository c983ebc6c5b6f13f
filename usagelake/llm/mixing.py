"""Mixing sources to target weights: hierarchical budgeting over a domain-language-source tree.

The token budget runs down the tree.  At every node it is shared among the
children by weight, no child above what its leaves can give (their tokens times
``max_epochs``); what a full child leaves over goes to its siblings.  A node is
cut off only when its whole subtree is full, so a shortage is made up by
siblings first and reaches an ancestor's level only then.  A leaf takes whole
epochs and, of the next one, the longest prefix in that epoch's seeded order
that its budget covers.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from usagelake.llm.common import staged, word_count

WORD = r"[^\x20\x09-\x0D]+"
SEED = 17
PREFIX = 3  # hex digits of the order key: 4,096 buckets of a leaf

# Target weights of the registered query; siblings not named weigh DEFAULT_WEIGHT.
DOMAIN_WEIGHTS = {"web": 5, "books": 3, "forum": 2}
LANG_WEIGHTS = {"en": 4, "de": 3, "fr": 2, "es": 2}
DEFAULT_WEIGHT = 1


def domain_of(source: Column) -> Column:
    """The domain of a source: a fixed rule on the first hex digit of its md5."""
    d = F.substring(F.md5(source), 1, 1)
    return F.when(d < "8", "web").when(d < "c", "books").otherwise("forum")


def weight_of(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for k, v in weights.items():
        out = F.when(name == k, v).otherwise(out)
    return out.cast("long")


def share(children: DataFrame, parent: list[str]) -> DataFrame:
    """Water-filling: ``given`` for children with ``name, cap, weight, budget`` of one ``parent``.

    With children in order of cap / weight, the common rate is the largest of
    (budget - caps before) / (weights from here on); a child gets the lesser of
    its cap and rate * weight, rounded down.  Children of weight 0 get 0.
    """
    node = [F.col(c) for c in parent] or [F.lit(0)]
    live = children.where("weight > 0")
    order = Window.partitionBy(*node).orderBy(F.col("cap") / F.col("weight"), "name")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rate = (F.col("budget") - before).cast("double") / ahead.cast("double")
    live = live.withColumn("rate", rate).withColumn("rate", F.max("rate").over(Window.partitionBy(*node)))
    given = F.floor(F.least(F.col("cap").cast("double"), F.col("rate") * F.col("weight"))).cast("long")
    return live.withColumn("given", F.greatest(given, F.lit(0).cast("long"))).drop("rate")


def budgets(leaves: DataFrame, fraction: float, max_epochs: int,
            domain_weights: dict[str, int], lang_weights: dict[str, int],
            source_weights: dict[str, int]) -> DataFrame:
    """``domain, lang, source, tokens, given`` from leaves with ``tokens``."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(F.floor(F.sum("tokens").cast("double") * fraction).cast("long")).first()[0] or 0
    usable = leaves.where((weight_of(F.col("domain"), domain_weights) > 0)
                          & (weight_of(F.col("lang"), lang_weights) > 0)
                          & (weight_of(F.col("source"), source_weights) > 0))
    domains = usable.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn(
        "budget", F.lit(total).cast("long")).withColumn(
        "name", F.col("domain")).withColumn("weight", weight_of(F.col("domain"), domain_weights))
    top = share(domains, []).select("domain", F.col("given").alias("budget"))
    langs = usable.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(top, "domain").withColumn(
        "name", F.col("lang")).withColumn("weight", weight_of(F.col("lang"), lang_weights))
    mid = share(langs, ["domain"]).select("domain", "lang", F.col("given").alias("budget"))
    low = usable.join(mid, ["domain", "lang"]).withColumn("name", F.col("source")).withColumn(
        "weight", weight_of(F.col("source"), source_weights))
    return share(low, ["domain", "lang"]).select("domain", "lang", "source", "tokens", "given")


def with_leaf(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns of ``docs``), ``doc_id``, the leaf and ``_tokens`` (words of the whole text)."""
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("(none)")) for c in ("lang", "source"))
    return docs.select(
        F.struct(*docs.columns).alias("doc"), "doc_id", domain_of(source).alias("_domain"), lang.alias("_lang"),
        source.alias("_source"),
        F.coalesce(word_count(F.col("text")), F.lit(0)).cast("long").alias("_tokens"))


def order_key(epoch: Column, seed: int) -> Column:
    """Place of a document in the seeded order of an epoch."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), ident))


_LEAF = ["_domain", "_lang", "_source"]


def cutoffs(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Per leaf its whole epochs ``_whole`` and the last order key ``_last`` of the next epoch's prefix.

    Sums per bucket of the order key find the bucket where the budget ends; only
    that bucket's rows are sorted, so a leaf with a third of all rows is spread out.
    """
    leaf = plan.select(F.col("domain").alias("_domain"), F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                       F.floor(F.col("given") / F.col("tokens")).cast("long").alias("_whole"),
                       (F.col("given") % F.col("tokens")).alias("_rest")).where("_whole is not null")
    keyed = rows.join(leaf, _LEAF).withColumn("_key", order_key(F.col("_whole"), seed)).withColumn(
        "_bucket", F.substring("_key", 1, PREFIX))
    sums = keyed.groupBy(*_LEAF, "_rest", "_whole", "_bucket").agg(F.sum("_tokens").alias("t"))
    run = Window.partitionBy(*_LEAF).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    edge = sums.withColumn("after", F.sum("t").over(run)).where(
        "after - t <= _rest and _rest < after").select(
            *_LEAF, F.col("_bucket"), (F.col("_rest") - F.col("after") + F.col("t")).alias("room"), "_whole")
    inside = keyed.drop("_whole", "_rest").join(edge.drop("_whole"), [*_LEAF, "_bucket"])
    # rows of one order key are peers of the running sum: taken or left together
    ranked = inside.withColumn("upto", F.sum("_tokens").over(Window.partitionBy(*_LEAF).orderBy("_key")))
    last = ranked.where("upto <= room").groupBy(*_LEAF).agg(F.max("_key").alias("k"))
    return edge.join(last, _LEAF, "left").select(
        *_LEAF, "_whole", F.coalesce("k", "_bucket").alias("_last"))


def mixed(docs: DataFrame, fraction: float = 1.0, max_epochs: int = 2, seed: int = SEED,
          domain_weights: dict[str, int] | None = None, lang_weights: dict[str, int] | None = None,
          source_weights: dict[str, int] | None = None) -> DataFrame:
    """Rows of ``docs`` that the mixture takes: ``doc`` (a struct of all columns, so that no name can
    clash), ``domain, lang, source, n_tokens`` and ``copies`` (1 or more).

    The budget is ``fraction`` of all tokens (words).  Null sources and languages are
    the name ``(none)``; null and empty texts have no tokens and are taken when the
    prefix reaches them; rows of one doc_id are taken or left together; a leaf
    without tokens gives nothing.
    """
    rows = with_leaf(docs)
    narrow = staged(rows.select("doc_id", *_LEAF, "_tokens"), "mixing")
    leaves = staged(narrow.groupBy(*_LEAF).agg(F.sum("_tokens").alias("tokens")).toDF(
        "domain", "lang", "source", "tokens").where("tokens > 0"), "leaves")
    plan = staged(budgets(leaves, fraction, max_epochs, DOMAIN_WEIGHTS if domain_weights is None else domain_weights,
                          LANG_WEIGHTS if lang_weights is None else lang_weights, source_weights or {}), "budgets")
    ends = staged(cutoffs(narrow, plan, seed), "cutoffs")
    found = rows.join(ends, _LEAF)
    copies = F.col("_whole") + F.when(order_key(F.col("_whole"), seed) <= F.col("_last"), 1).otherwise(0)
    return found.select(
        "doc", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"),
        F.col("_tokens").alias("n_tokens"), copies.cast("long").alias("copies")).where("copies > 0")


def op6(docs: DataFrame) -> DataFrame:
    """Documents of the mixture with their leaf, tokens and copies."""
    return mixed(docs.select("doc_id", "text", "lang", "source")).select(
        "doc.doc_id", "domain", "lang", "source", "n_tokens", "copies")


def _case(column: str, weights: dict[str, int]) -> str:
    when = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())
    return f"(CASE {column} {when} ELSE {DEFAULT_WEIGHT} END)" if weights else str(DEFAULT_WEIGHT)


def _share_sql(name: str, source: str, parent: str) -> str:
    part = f"PARTITION BY {parent} " if parent else ""
    return f"""
{name}_r AS (SELECT *, max((budget - before)::DOUBLE / ahead::DOUBLE) OVER ({part}) AS rate FROM (
  SELECT *, coalesce(sum(cap) OVER ({part}ORDER BY cap / weight, name
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER ({part}ORDER BY cap / weight, name
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead FROM {source})),
{name} AS (SELECT *, greatest(floor(least(cap::DOUBLE, rate * weight))::BIGINT, 0) AS given FROM {name}_r)"""


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0) AS n_tokens FROM documents),
l AS (SELECT *, CASE WHEN md5(source)[1] < '8' THEN 'web' WHEN md5(source)[1] < 'c' THEN 'books'
  ELSE 'forum' END AS domain FROM d),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, 2 * sum(n_tokens)::BIGINT AS cap
  FROM l GROUP BY ALL HAVING sum(n_tokens) > 0),
dom AS (SELECT domain, domain AS name, sum(cap)::BIGINT AS cap, {_case("domain", DOMAIN_WEIGHTS)} AS weight,
  (SELECT floor(sum(tokens)::DOUBLE * 1.0)::BIGINT FROM leaf) AS budget FROM leaf GROUP BY domain),
{_share_sql("top", "dom", "")},
lng AS (SELECT leaf.domain, leaf.lang, leaf.lang AS name, sum(leaf.cap)::BIGINT AS cap,
  {_case("leaf.lang", LANG_WEIGHTS)} AS weight, any_value(top.given) AS budget
  FROM leaf JOIN top ON leaf.domain = top.domain GROUP BY leaf.domain, leaf.lang),
{_share_sql("mid", "lng", "domain")},
src AS (SELECT leaf.domain, leaf.lang, leaf.source, leaf.source AS name, leaf.cap, leaf.tokens, 1 AS weight,
  mid.given AS budget FROM leaf JOIN mid ON leaf.domain = mid.domain AND leaf.lang = mid.lang),
{_share_sql("low", "src", "domain, lang")},
k AS (SELECT l.*, low.given // low.tokens AS whole, low.given % low.tokens AS rest,
  md5(concat('{SEED}:', low.given // low.tokens, ':', coalesce(l.doc_id::VARCHAR, ''))) AS key
  FROM l JOIN low ON l.domain = low.domain AND l.lang = low.lang AND l.source = low.source),
p AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM k)
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM p WHERE whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
"""
