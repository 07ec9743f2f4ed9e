"""How far the sources of a language differ in their terms (operator 13).

Sources are compared by the chi-square distance of their smoothed term shares: for every
ordered pair of sources of a language a sum over all kept terms, and for every source the
terms that stand out against the whole language.

A pair's sum is put together from what zero counts would give, what one source's counts
add, and a correction for the terms that both hold. The corrections come from a
frequent-pattern tree. A term's row lists the sources that hold it, in order, each with
its share; equal rows are one path with a multiplicity. Paths are sorted and inserted into
trees, where rows with a common beginning share its nodes. A node and each of its ancestors
are a pair of sources with fixed shares, so their correction is computed once for all terms
below, times the node's multiplicity.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm import common
from salesmart.operators.staging import stage

#: Terms in lower-cased UTF-8: letters and every byte of a character beyond ASCII.
_TERM_OR_END = re.compile(rb"[a-z\x80-\xff]+|\x00")

#: Corrections are summed in two limbs, the lower one of so many bits.
LIMB = 31


@dataclass(frozen=True)
class Audit:
    """least_docs: documents of a language that a kept term is in at least. unit: shares
    are whole numbers of 1 / unit. top: terms reported per source."""

    least_docs: int = 3
    unit: int = 1_000_000_000
    top: int = 200


# --- counts -------------------------------------------------------------------

_COUNTED = "lang string, source string, term string, n long, docs long"


def _count(batches):
    """Occurrences and documents of every term per language and source of a batch, and a
    row without a term for every language and source."""
    for batch in common.slices(batches, 2):
        names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        kinds = {name: number for number, name in enumerate(sorted(set(names)))}
        if not kinds:
            continue
        tokens = pa.array(common.words_and_ends(batch.column(2), _TERM_OR_END), pa.binary())
        coded = tokens.dictionary_encode()
        code = coded.indices.to_numpy()
        end = coded.dictionary.index(pa.scalar(common.END)).as_py()
        text = np.cumsum(code == end)[code != end]
        code, size = code[code != end].astype(np.int64), len(coded.dictionary)
        held, times = np.unique(text * size + code, return_counts=True)
        group = np.array([kinds[name] for name in names], np.int64)[held // size]
        found, own = np.unique(group * size + held % size, return_inverse=True)
        n = np.zeros(len(found), np.int64)
        np.add.at(n, own, times)
        langs, sources = (pa.array([name[i] for name in kinds], pa.string()) for i in (0, 1))
        of = pa.array(found // size)
        yield pa.RecordBatch.from_arrays(
            [langs.take(of), sources.take(of),
             coded.dictionary.take(pa.array(found % size)).cast(pa.string()),
             pa.array(n), pa.array(np.bincount(own, minlength=len(found)))],
            ["lang", "source", "term", "n", "docs"])
        nothing = pa.array(np.zeros(len(kinds), np.int64))
        yield pa.RecordBatch.from_arrays(
            [langs, sources, pa.nulls(len(kinds), pa.string()), nothing, nothing],
            ["lang", "source", "term", "n", "docs"])


def _share(n: str, total: str, terms: str, unit: int) -> Column:
    """1 + floor(unit * (n + 1) / (total + terms)), whatever the size of the counts."""
    return F.expr(f"1 + cast({unit} as decimal(12,0)) * cast({n} + 1 as decimal(20,0)) "
                  f"div cast({total} + {terms} as decimal(20,0))")


def _gap(p: str, q: str) -> str:
    """floor((p - q)^2 / q); shares are at most unit + 1, so the square fits 64 bits."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


# --- the tree -------------------------------------------------------------------

class Tree:
    """A prefix tree of paths. A step is (source, share, share of a zero count)."""

    def __init__(self):
        self.nodes: dict[tuple, int] = {}
        self.parent, self.step, self.times = [], [], []

    def insert(self, root, path, times: int) -> None:
        at = -1
        for step in path:
            key = (root if at < 0 else at, at < 0, step)
            node = self.nodes.get(key)
            if node is None:
                node = self.nodes[key] = len(self.parent)
                self.parent.append(at)
                self.step.append((root, *step))
                self.times.append(0)
            self.times[node] += times
            at = node

    def corrections(self) -> list[tuple]:
        """(root, source, other, high, low): what the terms that both sources hold add to
        the sum of the ordered pair, as high * 2**LIMB + low."""
        names = sorted({(root, source) for root, source, *_ in self.step})
        number = {name: k for k, name in enumerate(names)}
        group = np.array([number[s[:2]] for s in self.step], np.int64)
        share = np.array([s[2] for s in self.step], np.int64)
        zero = np.array([s[3] for s in self.step], np.int64)
        # Python's own numbers where sums over the terms could pass 64 bits.
        most = sum(t for t, p in zip(self.times, self.parent) if p < 0)
        times = np.array(self.times, np.int64 if most < 1 << LIMB else object)
        parent = np.array(self.parent, np.int64)
        high: dict[int, int] = {}
        low: dict[int, int] = {}
        node, above = np.arange(len(parent)), parent
        while True:
            node, above = node[above >= 0], above[above >= 0]
            if not len(node):
                break
            for a, b in ((above, node), (node, above)):
                value = (_gaps(share[a], share[b]) - _gaps(share[a], zero[b])
                         - _gaps(zero[a], share[b]) + _gaps(zero[a], zero[b]))
                pair, own = np.unique(group[a] * len(names) + group[b], return_inverse=True)
                for sums, limb in ((high, value >> LIMB), (low, value & ((1 << LIMB) - 1))):
                    total = np.zeros(len(pair), times.dtype)
                    np.add.at(total, own, limb * times[node])
                    for k, v in zip(pair.tolist(), total.tolist()):
                        sums[k] = sums.get(k, 0) + v
            above = parent[above]
        return [(*names[k // len(names)], names[k % len(names)][1], high[k], low[k]) for k in high]


_PATHS = "lang string, source string, item string, high string, low string"


def _corrections(batches):
    """Trees of the sorted paths (lang, path, times) of a batch each."""
    for batch in batches:
        tree = Tree()
        langs, steps, times = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
        flat = steps.flatten()
        items = list(zip(*(flat.field(i).to_pylist() for i in range(3))))
        bounds = np.r_[0, np.cumsum(np.array([len(s) for s in steps], np.int64))].tolist()
        for lang, first, last, m in zip(langs, bounds, bounds[1:], times):
            tree.insert(lang, items[first:last], m)
        rows = tree.corrections()
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[i] if i < 3 else map(str, columns[i]), pa.string()) for i in range(5)],
            ["lang", "source", "item", "high", "low"])


# --- the operator -----------------------------------------------------------------

def audit(docs: DataFrame, settings: Audit = Audit(), text_column: str = "text",
          lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: for each other source of the language the distance from it, over all
    kept terms. Part ``term``: the terms that are more frequent in the source than in its
    language, by distance, at most ``top``. Ranks go by value, equal values by the bytes
    of the item. Null texts, languages and sources are read as the empty text. A language
    whose terms all stay below ``least_docs`` documents has distances of 0 and no terms; a
    source without terms has only its smoothed shares; a language's only source has no
    pairs. Repeated rows are documents like others. Other columns are not read. An empty
    table gives an empty result. All arithmetic is exact; a distance beyond 64 bits fails.
    """
    def named(column):
        return F.coalesce(F.col(column), F.lit(""))

    counts = stage(
        docs.select(named(lang_column).alias("lang"), named(source_column).alias("source"),
                    named(text_column).alias("text"))
        .mapInArrow(_count, _COUNTED)
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "divergence_counts")
    held = counts.where("term is not null")
    kept = held.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_term")) \
        .where(F.col("docs") >= settings.least_docs).drop("docs")
    held = stage(held.drop("docs").join(kept, ["lang", "term"]), "divergence_kept")
    groups = stage(_groups(counts, held, settings), "divergence_groups")
    marked = stage(
        held.join(groups, ["lang", "source"])
        .withColumn("p", _share("n", "size", "terms", settings.unit))
        .withColumn("q", _share("of_term", "of_lang", "terms", settings.unit))
        .select("lang", "source", "term", "p", "zero", "q"), "divergence_shares")
    pairs = _pairs(marked, groups).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = marked.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.expr(_gap("p", "q")).alias("value"))
    place = F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    # The filter on the rank keeps ``top`` rows a group and task before they are shuffled.
    return pairs.withColumn("rank", place).unionByName(
        terms.withColumn("rank", place).where(F.col("rank") <= settings.top))


def _groups(counts: DataFrame, held: DataFrame, settings: Audit) -> DataFrame:
    """Per language and source: occurrences, those of the language, its kept terms, and
    the share of a term that the source does not hold."""
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    terms = held.groupBy("lang", "term").agg(F.sum("n").alias("n")) \
        .groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("of_lang"))
    known = counts.select("lang", "source").distinct() \
        .join(sizes, ["lang", "source"], "left").join(terms, "lang", "left") \
        .na.fill(0, ["size", "terms", "of_lang"])
    return known.withColumn("zero", F.when(
        F.col("terms") > 0, _share("0", "size", "terms", settings.unit)).otherwise(F.lit(1)))


def _pairs(marked: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the ordered pairs of sources of a language."""
    exact = "cast({} as decimal(38,0))"
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other"))
    nothing = groups.join(other, "lang").where("source <> item").select(
        "lang", "source", "item",
        F.expr(exact.format("terms") + " * " + exact.format(_gap("zero", "other"))).alias("value"))
    # What a source's own counts add where the other source has none, either way round.
    single = marked.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("times")) \
        .join(other, "lang").where("source <> item")
    there = f"{_gap('p', 'other')} - {_gap('zero', 'other')}"
    back = f"{_gap('other', 'p')} - {_gap('other', 'zero')}"
    one = single.select("lang", F.expr(
        f"inline(array(struct(source, item, {exact.format(there)} * times as value), "
        f"struct(item as source, source as item, {exact.format(back)} * times as value)))"))
    paths = (
        marked.groupBy("lang", "term")
        .agg(F.array_sort(F.collect_list(F.struct("source", "p", "zero"))).alias("path"))
        .groupBy("lang", "path").agg(F.count("*").alias("times")).where(F.size("path") > 1)
    )
    # Dealt by where paths begin, and a common beginning by hash: of whole paths the sample
    # that sets the ranges would be long.
    both = (
        paths.withColumn("start", F.slice("path", 1, 2)).withColumn("spread", F.xxhash64("path"))
        .repartitionByRange("lang", "start", "spread").select("lang", "path", "times")
        .sortWithinPartitions("lang", "path").mapInArrow(_corrections, _PATHS)
        .select("lang", "source", "item", F.expr(
            exact.format("high") + f" * cast({1 << LIMB} as decimal(10,0)) + "
            + exact.format("low")).alias("value"))
    )
    wide = [df.withColumn("value", F.col("value").cast("decimal(38,0)")) for df in (nothing, one, both)]
    return wide[0].unionByName(wide[1]).unionByName(wide[2]) \
        .groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def oracle_sql(settings: Audit = Audit()) -> str:
    """DuckDB SQL: every sum over every kept term, without a tree."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def share(n, total):
        return f"1 + {settings.unit}::HUGEINT * ({n} + 1) // ({total} + v)"

    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(list_concat(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), [NULL])) AS term FROM documents
), terms AS (
  SELECT lang, term, count(*) AS of_term FROM texts WHERE term IS NOT NULL
  GROUP BY lang, term HAVING count(DISTINCT row_no) >= {settings.least_docs}
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM texts JOIN terms USING (lang, term)
  GROUP BY lang, source, term
), langs AS (SELECT lang, count(*) AS v, sum(of_term) AS of_lang FROM terms GROUP BY lang
), known AS (SELECT DISTINCT lang, source FROM texts
), sizes AS (
  SELECT lang, source, coalesce(sum(n), 0) AS size FROM known LEFT JOIN counts USING (lang, source)
  GROUP BY lang, source
), shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, {share('coalesce(n, 0)', 'size')} AS p,
    {share('of_term', 'of_lang')} AS q
  FROM sizes JOIN langs USING (lang) JOIN terms USING (lang) LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM known a JOIN known b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY ALL
), rows AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR rank <= {settings.top}"""
