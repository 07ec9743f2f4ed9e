"""Mixing sources to target weights by iterative proportional fitting (operator 5).

Token weights are summed per cell of the dimensions (source, language, topic). Raking
scales the cells until every dimension has its target shares. A document is sampled with
the probability of its cell, by a hash of its id. DataFrame and SQL functions only; the
cells are the one thing that is iterated over, documents are read once and joined once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import WORD
from salesmart.operators.staging import stage

NONE = "(none)"
#: Words above which a text is an article, and a book.
ARTICLE, BOOK = 100, 1000


@dataclass(frozen=True)
class Targets:
    """dimensions: columns to rake. shares: wanted shares of named values per dimension,
    scaled to 1 over the values that have tokens. A dimension without wanted shares gets
    its own shares to the power ``smoothing``, scaled to 1. keep: share of all tokens
    that the sample should have. rounds: passes over the dimensions. seed: of the
    sampling hash."""

    dimensions: tuple[str, ...] = ("source", "lang", "topic")
    shares: dict[str, dict[str, float]] = field(default_factory=dict)
    smoothing: float = 0.7
    keep: float = 0.7
    rounds: int = 6
    seed: str = "mix"


def described(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with n_tokens (words) and topic, a kind of text by its form."""
    words = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    kind = (
        F.when(F.col(text_column).contains(" | "), "table")
        .when(F.lower(text_column).contains("license"), "legal")
        .when(F.col("n_tokens") < ARTICLE, "note")
        .when(F.col("n_tokens") < BOOK, "article").otherwise("book"))
    return docs.withColumn("n_tokens", words).withColumn("topic", kind)


def _uniform(id_column: str, seed: str):
    """A number in [0, 1) by the id: 52 bits of a digest."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(NONE)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def _target(dimension: str, targets: Targets):
    """The wanted share of a cell's value, before scaling."""
    wanted = targets.shares.get(dimension)
    if wanted is None:
        return F.pow(F.sum("weight").over(Window.partitionBy(dimension)), F.lit(targets.smoothing))
    share = F.lit(0.0)
    for value, w in sorted(wanted.items()):
        share = F.when(F.col(dimension) == value, F.lit(float(w))).otherwise(share)
    return share


def cell_probabilities(weighted: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """(dimensions, weight, probability) of every cell of (dimensions, n_tokens).

    A value's target is its share of the kept tokens, or all its tokens if they are fewer.
    No document is repeated: after every round a cell is trimmed to the tokens it has, and
    the next round moves the rest to other cells. A cell without tokens has probability
    0. Null values are one value, ``(none)``.
    """
    dims = list(targets.dimensions)
    cells = weighted.groupBy(*(F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(d) for d in dims)) \
        .agg(F.sum("n_tokens").cast("double").alias("weight")).where("weight > 0")
    for d in dims:
        cells = cells.withColumn(f"t_{d}", _target(d, targets))
    cells = stage(cells, "mix_cells")
    every = cells.agg(F.sum("weight")).first()[0] or 0.0
    for d in dims:
        # One row per value: the targets of the values that are there sum to 1.
        one = cells.groupBy(d).agg(F.max(f"t_{d}").alias("t"), F.sum("weight").alias("w"))
        total = one.agg(F.sum("t")).first()[0] or 1.0
        wanted = F.least(F.lit(targets.keep * every) * F.col("t") / F.lit(total), F.col("w"))
        cells = cells.drop(f"t_{d}").join(one.select(d, wanted.alias(f"t_{d}")), d)
    cells = stage(cells.withColumn("mass", F.col("weight")), "mix_targets")
    for _ in range(targets.rounds):
        for d in dims:
            held = F.sum("mass").over(Window.partitionBy(d))
            cells = cells.withColumn("mass", F.when(held > 0, F.col("mass") * F.col(f"t_{d}") / held)
                                     .otherwise(F.lit(0.0)))
        cells = stage(cells.withColumn("mass", F.least("mass", "weight")), "mix_round")
    return cells.select(*dims, "weight", (F.col("mass") / F.col("weight")).alias("probability"))


def mix(docs: DataFrame, targets: Targets = Targets(), id_column: str = "doc_id") -> DataFrame:
    """The documents with n_tokens, the dimensions, probability and sampled.

    Rows that repeat an id are sampled together. A null id has one fixed draw. A document
    of a cell without tokens is not sampled. Columns named n_tokens, topic, probability
    or sampled are replaced. An empty table gives an empty result.
    """
    dims = list(targets.dimensions)
    own = described(docs.drop("n_tokens", "topic", "probability", "sampled"))
    narrow = stage(own.select("n_tokens", *dims), "mix_documents")
    cells = cell_probabilities(narrow, targets)
    keyed = own
    for d in dims:
        keyed = keyed.withColumn(f"cell_{d}", F.coalesce(F.col(d).cast("string"), F.lit(NONE)))
    cells = stage(cells.select(*(F.col(d).alias(f"cell_{d}") for d in dims), "probability"), "mix_final")
    keyed = keyed.join(cells, [f"cell_{d}" for d in dims], "left")
    keyed = keyed.withColumn("probability", F.coalesce("probability", F.lit(0.0)))
    return keyed.withColumn("sampled", _uniform(id_column, targets.seed) < F.col("probability")) \
        .drop(*(f"cell_{d}" for d in dims))


def oracle_sql(targets: Targets = Targets()) -> str:
    """The same in DuckDB SQL, rounds written out, for dimensions without wanted shares."""
    dims = targets.dimensions
    names = ", ".join(dims)
    steps = [f"""described AS (
  SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, n_tokens,
         CASE WHEN contains(text, ' | ') THEN 'table'
              WHEN contains(lower(text), 'license') THEN 'legal'
              WHEN n_tokens < {ARTICLE} THEN 'note'
              WHEN n_tokens < {BOOK} THEN 'article' ELSE 'book' END AS topic
  FROM (SELECT *, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS n_tokens FROM documents))""",
             f"""cells AS MATERIALIZED (
  SELECT {names}, CAST(sum(n_tokens) AS DOUBLE) AS weight, CAST(sum(n_tokens) AS DOUBLE) AS mass
  FROM described GROUP BY {names} HAVING sum(n_tokens) > 0)"""]
    for d in dims:
        steps.append(f"""target_{d} AS MATERIALIZED (
  SELECT {d}, least({targets.keep} * sum(sum(weight)) OVER () * pow(sum(weight), {targets.smoothing})
         / sum(pow(sum(weight), {targets.smoothing})) OVER (), sum(weight)) AS t
  FROM cells GROUP BY {d})""")
    last = "cells"
    for r in range(targets.rounds):
        for d in dims:
            now = f"rake_{r}_{d}"
            others = ", ".join(f"c.{x}" for x in dims)
            steps.append(f"""{now} AS MATERIALIZED (
  SELECT {others}, c.weight, c.mass * t.t / sum(c.mass) OVER (PARTITION BY c.{d}) AS mass
  FROM {last} c JOIN target_{d} t ON c.{d} = t.{d})""")
            last = now
        steps.append(f"""round_{r} AS MATERIALIZED (
  SELECT {names}, weight, least(mass, weight) AS mass FROM {last})""")
        last = f"round_{r}"
    match = " AND ".join(f"d.{x} = c.{x}" for x in dims)
    return "WITH " + ",\n".join(steps) + f""",
chance AS (
  SELECT {names}, mass / weight AS probability FROM {last})
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens,
       round(coalesce(c.probability, 0), 9) AS probability,
       CAST(concat('0x', substr(md5(concat('{targets.seed}:', coalesce(CAST(d.doc_id AS VARCHAR), '{NONE}'))), 1, 13))
            AS BIGINT) / pow(2, 52) < coalesce(c.probability, 0) AS sampled
FROM described d LEFT JOIN chance c ON {match}"""
