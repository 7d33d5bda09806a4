"""Toxicity by a linear-chain conditional random field.

Documents are labelled, tokens are not: words and word beginnings that mark toxic
documents far more often than clean ones are found first, and their tokens in toxic
documents are the labelled ones (tag 1).  The field is trained on these tags, with
those words and beginnings as features.  Forward-backward marginals of a document's
tokens, expected number and largest, make its score through a logistic fit against
the document labels; tokens with a marginal of one half or more are the offending
spans.  Tokens without features keep a floor probability and do not enter the score,
so length alone never makes a text toxic.

Only the fit looks at labels, on a bounded sample of labelled documents outside the
held-out fifth: ``fit_rows`` rows at most, half of each label (more of one if the other
has fewer), each the lowest hashes of (doc_id, text).  The logistic fit weighs both
labels alike and its intercept is then set to the labels' shares in all labelled
documents, so neither the size nor the toxic share of the corpus starves the fit.
Scores use the text alone.

Defined results: null text counts as empty and gets the score of a text without
findings; without any usable label every score is 0; a doc_id with several labels
counts as toxic if one of them is 1; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from math import exp, lgamma, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import stored, text_of
from candela.llm.crf import Chain

WORD = re.compile(r"[^\W\d_]+")
FIT_ROWS = 4000
MOST_FEATURES = 5000
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: A feature stands in so many toxic sample documents at least, so many times as often (smoothed)
#: as in clean ones, and would by chance with this probability at most.
LEAST_TOXIC, LEAST_RATIO, MOST_CHANCE = 2, 12, 5e-4
WIDTH = 64


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) > k)]


@dataclass
class Model:
    features: dict[str, int]
    chain: Chain | None
    logistic: np.ndarray

    def hits(self, words: list[str], cache: dict[str, float | None]) -> tuple[list[int], list[float]]:
        """Places of the words that have features, and their summed weights."""
        at, scores = [], []
        for i, word in enumerate(words):
            if word not in cache:
                known = [self.features[f] for f in features_of(word) if f in self.features]
                if len(cache) >= 500_000:
                    cache.clear()
                cache[word] = float(self.chain.emit[known].sum()) if known else None
            score = cache[word]
            if score is not None:
                at.append(i)
                scores.append(score)
        return at, scores

    def score(self, text: str, cache: dict[str, float | None]) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and (start, end, marginal) of its toxic tokens."""
        if self.chain is None:
            return 0.0, []
        words = WORD.findall(text.lower())
        at, scores = self.hits(words, cache)
        spans: list[tuple[int, int, float]] = []
        evidence = np.zeros(2)
        if at:
            p = self.chain.marginals(at, scores, len(words))
            evidence = _evidence(p)
            found = {i: float(x) for i, x in zip(at, p) if x >= 0.5}
            if found and len(text.lower()) == len(text):
                spans = [(m.start(), m.end(), found[i])
                         for i, m in enumerate(WORD.finditer(text.lower())) if i in found]
            elif found:  # lowering changed the length: find the words in the text itself
                spans = [(m.start(), m.end(), 1.0) for m in WORD.finditer(text)
                         if cache.get(m.group().lower()) is not None]
        return float(_logistic(self.logistic, evidence[None])[0]), spans


def _evidence(p: np.ndarray) -> np.ndarray:
    return np.array([np.log1p(p.sum()), p.max()])


def _logistic(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))


def _fit_logistic(x: np.ndarray, y: np.ndarray, sizes: tuple[int, int], ridge: float = 0.5) -> np.ndarray:
    """Newton's method on the penalised likelihood (the intercept is free).

    Both labels weigh alike; the intercept then takes the prior odds of ``sizes`` (clean, toxic).
    """
    prior = log((sizes[1] + 0.5) / (sizes[0] + 0.5))
    ones = int(y.sum())
    if ones in (0, len(y)) or not x.any():
        return np.r_[prior, np.zeros(x.shape[1])]
    weight = np.where(y == 1, len(y) / (2 * ones), len(y) / (2 * (len(y) - ones)))
    z = np.c_[np.ones(len(x)), x]
    w = np.zeros(z.shape[1])
    keep = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(30):
        p = _logistic(w, x)
        w = w - np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + keep, z.T @ (weight * (p - y)) + keep @ w)
    return w + np.r_[prior, np.zeros(x.shape[1])]


def _chance(toxic: int, clean: int, share: float) -> float:
    """Probability that so many or more of a feature's documents are toxic, if ``share`` of all are."""
    n = toxic + clean
    term = exp(lgamma(n + 1) - lgamma(toxic + 1) - lgamma(clean + 1)
               + toxic * log(share) + clean * log(1 - share))
    total = 0.0
    for k in range(toxic, n + 1):
        total += term
        term *= (n - k) / (k + 1) * share / (1 - share)
    return total


def _chosen(counts: list[Counter], sizes: tuple[int, int]) -> list[str]:
    """Features (counted in clean and toxic documents, of which there are ``sizes``) that mark toxic ones."""
    clean, toxic = sizes
    if not clean or not toxic:
        return []
    chances: dict[tuple[int, int], float] = {}
    found = []
    for f, n in counts[1].items():
        other = counts[0][f]
        if n < LEAST_TOXIC or (n + 0.5) * (clean + 1) < LEAST_RATIO * (other + 0.5) * (toxic + 1):
            continue
        if (n, other) not in chances:
            chances[n, other] = _chance(n, other, toxic / (clean + toxic))
        if chances[n, other] <= MOST_CHANCE:
            found.append(f)
    return sorted(found, key=lambda f: (-counts[1][f], f))[:MOST_FEATURES]


def _unlike(words: list[list[str]], keep: int = 16) -> list[int]:
    """Documents without those that share half of their least word hashes with an earlier one."""
    kept, holders = [], {}
    for i, own in enumerate(words):
        least = sorted({crc32(w.encode()) for w in own})[:keep]
        shared = Counter(j for h in least for j in holders.get(h, ()))
        if shared and max(shared.values()) * 2 >= max(len(least), 2):
            continue
        kept.append(i)
        for h in least:
            holders.setdefault(h, []).append(i)
    return kept


def fit_model(texts: list[str], toxic: list[int], sizes: tuple[int, int] | None = None) -> Model:
    """Train on documents and their labels, drawn from ``sizes`` (clean, toxic) documents (default: all given)."""
    words = [WORD.findall(t.lower()) for t in texts]
    own = _unlike(words)
    words, y = [words[i] for i in own], np.array([toxic[i] for i in own], int)
    if not len(y):
        return Model({}, None, np.zeros(3))
    counts = [Counter(), Counter()]
    for w, label in zip(words, y):
        counts[label].update({f for x in set(w) for f in features_of(x)})
    ones = int(y.sum())
    chosen = _chosen(counts, (len(y) - ones, ones))
    model = Model({f: i for i, f in enumerate(chosen)}, Chain(len(chosen)), np.zeros(3))

    combo_of: dict[tuple[int, ...], int] = {(): 0}
    cache: dict[str, int] = {}
    quiet: Counter = Counter()
    rows, tags = [], []
    for w, label in zip(words, y):
        ids = []
        for x in w:
            if x not in cache:
                has = tuple(model.features[f] for f in features_of(x) if f in model.features)
                cache[x] = combo_of.setdefault(has, len(combo_of))
            ids.append(cache[x])
        for at in range(0, len(ids), WIDTH):
            some = ids[at:at + WIDTH]
            if any(some):
                rows.append(some)
                tags.append([int(label and c > 0) for c in some])
            else:
                quiet[len(some)] += 1
    weights = np.array([1.0] * len(rows) + [float(n) for n in quiet.values()])
    rows += [[0] * n for n in quiet]
    tags += [[0] * n for n in quiet]
    if rows:
        pad = lambda xs: np.array([x + [0] * (WIDTH - len(x)) for x in xs])
        model.chain.fit(pad(rows), list(combo_of), pad(tags), np.array([len(r) for r in rows]), weights)
    model.chain.prepare()
    evidence, scores = np.zeros((len(y), 2)), {}
    for i, w in enumerate(words):
        at, found = model.hits(w, scores)
        if at:
            evidence[i] = _evidence(model.chain.marginals(at, found, len(w)))
    model.logistic = _fit_logistic(evidence, y, sizes or (len(toxic) - sum(toxic), sum(toxic)))
    return model


def held_out() -> Column:
    """Whether a document belongs to the fifth that no fit may see."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 5 == 0


def fit_on(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on ``fit_rows`` labelled documents at most outside the held-out fifth.

    Labels meet the documents first; of rows equal in (doc_id, text) one counts.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("toxic in (0, 1) and doc_id is not null").filter(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("t")).withColumn("th", F.xxhash64("t"))
    keys = stored(texts.filter("doc_id is not null").select("doc_id", "th").distinct().join(known, "doc_id")
                  .select("doc_id", "th", "toxic", F.xxhash64("doc_id", "th").alias("h")), "fit-keys")
    counted = {r["toxic"]: r["count"] for r in keys.groupBy("toxic").count().collect()}
    sizes = counted.get(0, 0), counted.get(1, 0)
    ones = min(sizes[1], max((fit_rows + 1) // 2, fit_rows - sizes[0]))
    drawn = [keys.filter(F.col("toxic") == y).orderBy("h", "doc_id", "th").limit(n).drop("h")
             for y, n in ((0, fit_rows - ones), (1, ones))]
    rows = (texts.join(F.broadcast(drawn[0].unionByName(drawn[1])), ["doc_id", "th"])
            .groupBy("doc_id", "th", "toxic").agg(F.min("t").alias("t")).collect())
    rows.sort(key=lambda r: (r["doc_id"], r["t"]))
    return fit_model([r["t"] for r in rows], [r["toxic"] for r in rows], sizes)


def toxic_spans(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxicity``: struct of score and spans (start, end, marginal; characters)."""
    kind = "struct<score: double, spans: array<struct<start: int, end: int, p: double>>>"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_FEATURES
    cache: dict[str, float | None] = {}

    @F.arrow_udf(kind)
    def scored(texts: pa.Array) -> pa.Array:
        found = [shared.value.score(t, cache) for t in texts.to_pylist()]
        return pa.array([{"score": s, "spans": [dict(zip(("start", "end", "p"), x)) for x in spans]}
                         for s, spans in found],
                        pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct(
                            [("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))]))

    return docs.withColumn("toxicity", scored(text_of()))


def toxicity_report(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_spans."""
    found = toxic_spans(docs.select("doc_id", "text"), fit_on(docs, labels, fit_rows))
    score = F.col("toxicity.score")
    return found.select("doc_id", held_out().alias("held_out"), score.alias("score"),
                        (score >= 0.5).cast("int").alias("predicted"),
                        F.size("toxicity.spans").alias("n_spans"))


def drop_toxic(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` without those whose score is one half or more; columns unchanged."""
    columns = docs.columns
    held = docs.select(F.struct("*").alias("row"), F.col("text"))
    found = toxic_spans(held, fit_on(docs, labels, fit_rows))
    return found.filter("toxicity.score < 0.5").select(
        *[F.col("row").getField(c).alias(c) for c in columns])
