"""Quality of documents by hierarchical empirical Bayes (operator 7).

A logistic model of the text's form gives each document its own evidence. Hosts, and paths
within hosts, gather the evidence of their documents; a sparse path is shrunk toward its
host and a sparse host toward all documents, by strengths estimated from the spread between
them. A document's score joins its own evidence with the posterior of its path, in which
it does not count itself. All sums are grouped aggregates that combine before they shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import common
from salesmart.operators.staging import stage

FEATURES = ("log_words", "word_length", "symbols", "capitals", "digits", "same_as_last",
            "distinct", "per_line", "bars")


@dataclass(frozen=True)
class Settings:
    """most_rows: bound of the labelled rows the document model is fitted on. site_weight:
    share of a path's log-odds that is added to a document's. least: score to be kept.
    max_strength: pseudo-documents of a prior at most."""

    most_rows: int = 20_000
    site_weight: float = 0.5
    least: float = 0.5
    max_strength: float = 1000.0
    ridge: float = 1e-2


def _classes() -> np.ndarray:
    out = np.zeros((4, 256), np.float64)
    out[0, [ord(c) for c in "#*$%&<>!"]] = 1
    out[1, 65:91] = 1
    out[2, 48:58] = 1
    out[3, ord("|")] = 1
    return out


def form(column: pa.Array) -> np.ndarray:
    """[text, feature] of the form of texts; null and empty texts are all zero."""
    raw, bounds = common.text_buffer(column)
    starts, ends = common.word_spans(raw, bounds)
    hashes = common.word_hashes(raw, starts, ends)
    cut = np.searchsorted(starts, bounds)
    sums = [np.r_[0, np.cumsum(c[raw])] for c in _classes()]
    lines = np.r_[0, np.cumsum(raw == 10)]
    same = np.r_[False, hashes[1:] == hashes[:-1]].astype(np.float64) if len(hashes) else hashes
    out = np.zeros((len(bounds) - 1, len(FEATURES)))
    for i in range(len(out)):
        a, b, first, last = bounds[i], bounds[i + 1], cut[i], cut[i + 1]
        n = last - first
        if not n:
            continue
        size = b - a
        out[i] = (
            np.log(n), min(size / n, 50), (sums[0][b] - sums[0][a]) / size,
            (sums[1][b] - sums[1][a]) / size, (sums[2][b] - sums[2][a]) / size,
            same[first + 1 : last].sum() / n, len(np.unique(hashes[first:last])) / n,
            np.log(n / (1 + lines[b] - lines[a])), (sums[3][b] - sums[3][a]) / n)
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Probabilities; squares of the features are features too."""
        return 1 / (1 + np.exp(-np.clip(self.expanded(x) @ self.weights, -30, 30)))

    def expanded(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        return np.hstack([z, z * z, np.ones((len(x), 1))])


def fit(x: np.ndarray, y: np.ndarray, ridge: float) -> Logistic:
    """Ridge logistic regression by Newton steps; without both classes, the rate."""
    spread = x.std(0) if len(x) else np.zeros(len(FEATURES))
    model = Logistic(x.mean(0) if len(x) else np.zeros(len(FEATURES)),
                     np.where(spread > 0, spread, 1.0), np.zeros(2 * len(FEATURES) + 1))
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model.weights[-1] = np.log(rate / (1 - rate))
    if 0 < y.sum() < len(y):
        z = model.expanded(x)
        for _ in range(30):
            p = model(x)
            slope = z.T @ (p - y) + ridge * len(y) * model.weights
            curve = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * len(y) * np.eye(z.shape[1])
            step = np.linalg.solve(curve, slope)
            model.weights -= step
            if np.abs(step).max() < 1e-6:
                break
    return model


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(),
          id_column: str = "doc_id", text_column: str = "text") -> Logistic:
    """The document model from at most about ``most_rows`` labelled rows, taken by a hash
    of the id. Null texts, labels and ids are not used."""
    marked = labels.select(F.col(id_column).cast("long").alias("doc_id"),
                           F.col("quality").cast("int").alias("quality")) \
        .where("doc_id is not null and quality in (0, 1)").groupBy("doc_id") \
        .agg(F.max("quality").alias("quality"))
    share = min(1.0, settings.most_rows / max(marked.count(), 1))
    # The drawn labels are about ``most_rows`` rows however many there are, 12 bytes each,
    # so they can be sent to every task and no text is shuffled to meet them.
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < share * (1 << 20)

    def run(batches):
        for batch in common.slices(batches, 0):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(form(batch.column(0))), pa.list_(pa.float64())), batch.column(1)],
                ["x", "quality"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")) \
        .where("text is not null").where(drawn).join(F.broadcast(marked.where(drawn)), "doc_id") \
        .select("text", "quality") \
        .mapInArrow(run, "x array<double>, quality int").collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["quality"] for r in rows], np.float64), settings.ridge)


def document_scores(docs: DataFrame, model: Logistic, text_column: str = "text") -> DataFrame:
    """(doc_id, source, own), one row per input row of (doc_id, source, text)."""
    def run(batches):
        for batch in common.slices(batches, 2):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(model(form(batch.column(2))))],
                ["doc_id", "source", "own"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"), F.col(text_column).alias("text")) \
        .mapInArrow(run, "doc_id long, source string, own double")


def _strength(groups: DataFrame, mean: str, settings: Settings) -> float:
    """Pseudo-documents of a beta prior by the method of moments: the spread of the group
    means around the prior mean, less what their sizes explain. One row to the driver."""
    row = groups.where("n > 1").agg(
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(mean), 2)).alias("between"),
        F.sum(F.col("q") - F.pow(F.col("s"), 2) / F.col("n")).alias("within"),
        F.sum(F.col("n") - 1).alias("free"), F.sum("n").alias("n"), F.count("*").alias("groups"),
    ).first()
    if not row["groups"] or not row["free"]:
        return settings.max_strength
    within = max(row["within"] / row["free"], 1e-9)
    between = max((row["between"] - row["groups"] * within) / row["n"], within / settings.max_strength)
    return min(settings.max_strength, within / between)


def site_posteriors(scored: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``scored`` (doc_id, host, path, own) with host_posterior, path_posterior, score and
    kept. A document is left out of the sums of its own host and path."""
    sums = [F.count("*").alias("n"), F.sum("own").alias("s"), F.sum(F.col("own") * F.col("own")).alias("q")]
    overall = scored.agg(*sums).first()
    prior = (overall["s"] or 0.0) / overall["n"] if overall["n"] else 0.5
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    paths = stage(scored.groupBy("host", "path").agg(*sums), "quality_paths")
    hosts = stage(paths.groupBy("host").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")), "quality_hosts")
    hosts = hosts.withColumn("prior", F.lit(prior))
    of_host = _strength(hosts, "prior", settings)
    host_mean = (F.lit(of_host * prior) + F.col("host_s")) / (F.lit(of_host) + F.col("host_n"))
    both = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), "host")
    of_path = _strength(both.withColumn("mean", host_mean), "mean", settings)
    joined = scored.join(both.select("host", "path", "n", "s", "host_n", "host_s"), ["host", "path"])
    host_posterior = (F.lit(of_host * prior) + F.col("host_s") - F.col("own")) \
        / (F.lit(of_host - 1.0) + F.col("host_n"))
    path_posterior = (F.lit(of_path) * F.col("host_posterior") + F.col("s") - F.col("own")) \
        / (F.lit(of_path - 1.0) + F.col("n"))

    def odds(p):
        p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
        return F.log(p / (1 - p))

    z = odds(F.col("own")) + F.lit(settings.site_weight) * (odds(F.col("path_posterior")) - odds(F.lit(prior)))
    return joined.withColumn("host_posterior", host_posterior) \
        .withColumn("path_posterior", path_posterior).withColumn("score", 1 / (1 + F.exp(-z))) \
        .withColumn("kept", F.col("score") >= settings.least) \
        .drop("n", "s", "host_n", "host_s")


def with_sites(scored: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, host, path, own) of (doc_id, source, own): host and first path segments of the page with the
    document's id; a document without a page has its source as host and no path. Of
    several pages with one id the smallest url counts."""
    url = pages.where("page_id is not null").groupBy(F.col("page_id").cast("long").alias("doc_id")) \
        .agg(F.min("url").alias("url"))
    joined = scored.join(url, "doc_id", "left")
    host = F.lower(F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1))
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]*)", 1)
    return joined.select(
        "doc_id",
        F.when(F.length(host) > 0, host)
        .otherwise(F.concat(F.lit("source:"), F.coalesce("source", F.lit("")))).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"), "own")


def classify(docs: DataFrame, pages: DataFrame, labels: DataFrame,
             settings: Settings = Settings()) -> DataFrame:
    """(doc_id, host, path, own, host_posterior, path_posterior, score, kept), a row per row.

    Null and empty texts have the evidence of an empty form. Repeated rows count as rows.
    Other columns are not read; without labels every document has an even chance.
    """
    model = train(docs, labels, settings)
    scored = stage(document_scores(docs, model), "quality_scores")
    return site_posteriors(stage(with_sites(scored, pages), "quality_sites"), settings)
