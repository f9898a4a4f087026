"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; the unlabelled texts are drawn from all training rows, toxic
ones among them. With the share of toxic texts as class prior, the risk of a classifier can be
estimated without any confirmed clean text, and the part of it that belongs to clean texts is kept
from turning negative. The classifier is linear over words that are present, fitted with numpy on a
bounded sample; every row of the table is scored where it lies.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.rows import as_batches, byte_texts, fold_of, word_runs
from martloom.storage import store

SCORE = "__toxicity"

#: Lengths in bytes of the stems that are looked at beside whole words.
STEMS = (5, 4)


@dataclass(frozen=True)
class Settings:
    #: The most toxic and the most unlabelled rows that the fit sees, taken by a hash of the key.
    positives: int = 4000
    unlabelled: int = 8000
    #: Words of the model, and the share of the sampled texts a word must occur in, three texts at least.
    terms: int = 512
    least_share: float = 1 / 600
    #: How many standard errors the share of a word among toxic texts must differ from that among all. With few toxic texts no
    #: word can differ by as much, so that a part of the square root of their number is enough.
    least_errors: float = 5.0
    errors_by_root: float = 0.6
    #: Share of toxic texts among all; by default `margin` times the share among the labelled training
    #: rows. Below the true share the fit takes toxic texts for clean ones; above it the bound on the
    #: clean part of the risk keeps the harm small.
    prior: float | None = None
    margin: float = 1.25
    epochs: int = 200
    #: A small sample is gone through more often, for so many steps at least.
    least_steps: int = 800
    batch: int = 2000
    rate: float = 0.05
    ridge: float = 1e-5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[bytes, float]

    def score(self, words: set[bytes]) -> float:
        known = self.weights
        z = self.bias + math.fsum(known[w] for w in words if w in known)
        return 1 / (1 + math.exp(-min(max(z, -700.0), 700.0))) if z > -math.inf else 0.0


def _plain_table() -> bytes:
    table = bytearray(range(256))
    for c in range(128):
        table[c] = ord(chr(c).lower()) if chr(c).isalnum() else 32
    return bytes(table)


_PLAIN = _plain_table()


def words_of(data: bytes) -> set[bytes]:
    """The different words of a text and the stems they begin with, marked by a star.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased; stems are their first bytes.
    """
    found: set[bytes] = set()
    for words in word_runs(data, lambda part: part.translate(_PLAIN)):
        found.update(words)
    for n in STEMS:
        found |= {w[:n] + b"*" for w in found if len(w) > n}
    return found


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, settings: Settings = Settings()) -> tuple[float, np.ndarray]:
    """(bias, weights) of a linear classifier over 0/1 rows that minimises the non-negative risk.

    Risk: prior * E_pos[l(z)] + max(0, E_unl[l(-z)] - prior * E_pos[l(-z)]) with the logistic loss l.
    In a batch whose second part is negative, the step climbs that part instead.
    """
    rng = np.random.default_rng(settings.seed)
    d = unlabelled.shape[1]
    w, first, second, step = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1), 0
    w[d] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    pull = lambda x, g: np.append(x.T @ g, g.sum()) / len(x)
    loss = lambda z: np.logaddexp(0, -z)
    for _ in range(max(settings.epochs, -(-settings.least_steps // -(-len(unlabelled) // settings.batch)))):
        order = rng.permutation(len(unlabelled))
        for at in range(0, len(order), settings.batch):
            u = unlabelled[order[at : at + settings.batch]].astype(np.float64)
            p = positive[rng.integers(0, len(positive), min(len(positive), settings.batch))].astype(np.float64)
            zu, zp = u @ w[:d] + w[d], p @ w[:d] + w[d]
            clean = loss(-zu).mean() - prior * loss(-zp).mean()
            of_clean = pull(u, sigmoid(zu)) - prior * pull(p, sigmoid(zp))
            gradient = of_clean + prior * pull(p, sigmoid(zp) - 1) if clean >= 0 else -of_clean
            gradient[:d] += settings.ridge * w[:d]
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            w -= settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return float(w[d]), w[:d]


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Fit on training rows of `labels`, those whose crc32 of the key as text is not divisible by 5.

    Without a toxic training row every text scores 0. A key labelled more than once is toxic if any
    of its labels says so; null labels and null keys do not count.
    """
    marks = labels.select(labels[key].alias("id"), labels[label].alias("mark")).dropna().filter(fold_of(F.col("id")) != 0)
    marks = marks.groupBy("id").agg(F.max("mark").alias("mark"))
    prior = settings.prior
    if prior is None:
        prior = settings.margin * (marks.agg(F.avg((F.col("mark") == 1).cast("double"))).first()[0] or 0.0)
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text")).filter("id IS NOT NULL")
    rows = rows.filter(fold_of(F.col("id")) != 0)
    draw = F.xxhash64(F.lit(settings.seed), "id")
    toxic = marks.filter("mark = 1").select("id").orderBy(draw, "id").limit(settings.positives)
    others = rows.select("id").orderBy(draw, "id").limit(settings.unlabelled)
    # both lists are bounded by the settings, and so is what the join keeps unless keys repeat
    chosen = toxic.withColumn("positive", F.lit(True)).unionByName(others.withColumn("positive", F.lit(False)))
    sample = store(_with_words(rows.join(F.broadcast(chosen), "id")), "toxicity_sample")
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    prior = min(prior, 0.9)
    if not n_pos or not n_unl or not prior:
        return Model(-math.inf, {})
    share = lambda c, n: (F.count_if(c) + 0.5) / (n + 1.0)
    seen = sample.select("positive", F.explode("words").alias("word")).groupBy("word")
    in_pos, in_unl = F.col("positive"), ~F.col("positive")
    terms = seen.agg(F.count("*").alias("n"), share(in_pos, n_pos).alias("p"), share(in_unl, n_unl).alias("u"))
    terms = terms.filter(F.col("n") >= max(3.0, settings.least_share * (n_pos + n_unl)))
    least_errors = min(settings.least_errors, settings.errors_by_root * math.sqrt(n_pos))
    terms = terms.withColumn(
        "weight",
        F.abs(F.col("p") - F.col("u"))
        / F.sqrt(F.col("p") * (1 - F.col("p")) / n_pos + F.col("u") * (1 - F.col("u")) / n_unl),
    )
    best = [bytes(r["word"]) for r in terms.filter(F.col("weight") >= least_errors).orderBy(F.desc("weight"), "word").limit(settings.terms).collect()]
    place = {w: i for i, w in enumerate(best)}
    width = len(best)

    def to_places(batches):
        for batch in batches:
            found = [np.array(sorted(place[w] for w in ws if w in place), np.uint16) for ws in batch.column("words").to_pylist()]
            data = pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.record_batch([batch.column("positive"), data], ["positive", "places"])

    kept = as_batches("to_places", "positive BOOLEAN, places BINARY", sample.select("positive", "words"), to_places).toArrow()
    matrix = np.zeros((kept.num_rows, width), np.float32)
    for i, x in enumerate(kept.column("places").to_pylist()):
        matrix[i, np.frombuffer(x, np.uint16)] = 1
    positive = kept.column("positive").to_numpy()
    # rows in one order, so that a repeated fit gives the same model
    found = kept.column("places").to_pylist()
    order = np.array(sorted(range(len(found)), key=found.__getitem__))
    matrix, positive = matrix[order], positive[order]
    bias, weights = fit(matrix[positive], matrix[~positive], float(prior), settings)
    return Model(bias, dict(zip(best, weights.tolist())))


def _with_words(rows: DataFrame) -> DataFrame:
    def split(batches):
        for batch in batches:
            words = pa.array([sorted(words_of(x)) for x in byte_texts(batch)], pa.list_(pa.binary()))
            yield pa.record_batch([batch.column("positive"), words], ["positive", "words"])

    return as_batches("split_words", "positive BOOLEAN, words ARRAY<BINARY>", rows.select("positive", "text"), split)


def with_scores(docs: DataFrame, model: Model, text: str = "text", into: str = SCORE) -> DataFrame:
    """`docs` with a score, 0 to 1, in a column that they do not have yet; rows are not moved. Null text scores as an empty one."""
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])

    def score(batches):
        for batch in batches:
            scores = pa.array([model.score(words_of(x)) for x in byte_texts(batch, text)], pa.float64())
            yield pa.record_batch([*batch.columns, scores], [*batch.schema.names, into])

    return docs.mapInArrow(score, schema)


def predictions(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, held_out, score, predicted. An empty table gives no rows."""
    rows = with_scores(docs.select(key, text), model, text)
    return rows.select(
        key,
        (fold_of(rows[key]) == 0).alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= 0.5).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs` that the model does not hold toxic, with their columns as they were, whatever their names.

    Null texts are judged as empty ones, repeated rows alike, and long texts whole. An empty table gives no rows.
    """
    into = SCORE
    while into in docs.columns:
        into += "_"
    return with_scores(docs, model, text, into).filter(F.col(into) < 0.5).drop(into)
