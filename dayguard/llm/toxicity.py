"""Toxicity by maximum-scoring segments of token log-odds.

Method
  1. Token log-odds of toxic against clean training texts with an informative
     Dirichlet prior (prior mass spread like the corpus); every distinct training
     text counts once, a token once per text. Words that inflect share their stem's
     odds: a word without odds of its own takes those of its first five, then four letters.
  2. A linear scan (all maximal scoring segments, Ruzzo and Tompa) over the token
     scores less a drift finds every toxic passage.
  3. Extreme-value statistics: lambda solves sum p0(t) exp(lambda s(t)) = 1 on the
     clean token frequencies, K comes from the maxima of clean training texts; a
     segment of score S in a text of n tokens has E = K n exp(-lambda S).
  4. A text's evidence is the sum of -ln E over its segments with E < 1; a logistic
     curve fitted on all training rows turns it into a probability.

The vocabulary is every token with |z| >= ``z_min``, however many (the model holds them
all in memory); every other token has the neutral score. Counts and fits use all training rows.

Defined cases: null text scores like an empty one (the curve at no evidence); label
rows with a null label, or whose text is missing, teach nothing; a doc_id with
several labels takes the highest; repeated rows are scored each; without training
rows of both labels every score is 0.5 x the training share of toxic rows (0 if none).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayguard.llm.common import spool

TOKEN = re.compile(r"[^\W\d_]+")
SEGMENTS = "struct<n_tokens:bigint,segments:array<struct<start:int,end:int,score:double>>>"
FLUSH = 200_000  # tokens a task counts before it hands its counts on


@dataclass
class ToxicModel:
    weights: dict[str, float] = field(default_factory=dict)
    drift: float = math.log(4.0)
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    bias: float = -30.0


def folded(text: str) -> str:
    """Lower case with every code point kept in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(
        c.lower() if len(c.lower()) == 1 else c for c in text)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [first, last] of a score sequence, in linear time.

    Only positive scores can start or end a segment, so the scan visits those and
    takes the sums between them from the running total.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[list] = []  # [first, last, total before, total after]
    for p in np.flatnonzero(scores > 0).tolist():
        now = [p, p, total[p], total[p + 1]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= now[2]:
                j -= 1
            if j < 0 or found[j][3] >= now[3]:
                found.append(now)
                break
            now = [found[j][0], now[1], found[j][2], now[3]]
            del found[j:]
    return [(a, b, float(r - left)) for a, b, left, r in found]


def units(word: str) -> tuple[str, ...]:
    """What a word is counted as, the most particular first."""
    if len(word) > 5:
        return word, word[:5] + "*", word[:4] + "*"
    return (word, word[:4] + "*") if len(word) > 4 else (word,)


class Scorer(dict):
    """word -> log-odds less the drift; made on first use, a bounded number is kept."""

    def __init__(self, weights: dict[str, float], drift: float, most: int = 100_000):
        super().__init__()
        self.weights, self.drift, self.most = weights, drift, most

    def __missing__(self, word: str) -> float:
        s = next((self.weights[u] for u in units(word) if u in self.weights), 0.0) - self.drift
        if len(self) >= self.most:
            self.clear()
        self[word] = s
        return s


def text_segments(text: str | None, scorer: Scorer):
    """(number of tokens, [(start, end, score)] in code points) of one whole text."""
    if not text:
        return 0, []
    low = folded(text)
    tokens = TOKEN.findall(low)
    scores = np.fromiter(map(scorer.__getitem__, tokens), float, len(tokens))
    segments = maximal_segments(scores)
    if not segments:
        return len(tokens), []
    places = [m.span() for m in TOKEN.finditer(low)]
    return len(tokens), [(places[a][0], places[b][1], s) for a, b, s in segments]


def segments_column(text: Column, model: ToxicModel) -> Column:
    """struct(n_tokens, segments) of every text."""
    weights, drift = model.weights, model.drift

    @F.pandas_udf(SEGMENTS)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(weights, drift)
        for batch in texts:
            n, found = [], []
            for t in batch:
                k, s = text_segments(t, scorer)
                n.append(k)
                found.append([{"start": a, "end": b, "score": x} for a, b, x in s])
            yield pd.DataFrame({"n_tokens": n, "segments": found})

    return scan(text)


def evidence_column(n_tokens: Column, segments: Column, model: ToxicModel) -> Column:
    """Sum of -ln E over the segments with E < 1."""
    floor = F.log(F.greatest(n_tokens, F.lit(1))) + F.lit(math.log(model.k))
    return F.aggregate(segments, F.lit(0.0), lambda total, s: total + F.greatest(
        F.lit(0.0), F.lit(model.lam) * s["score"] - floor))


def score_column(evidence: Column, model: ToxicModel) -> Column:
    z = F.lit(model.bias) + F.lit(model.slope) * F.log1p(evidence)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_tokens(batches):
    counts: Counter = Counter()
    toxic: Counter = Counter()

    def out():
        keys = list(counts)
        return pd.DataFrame({"token": keys, "n": [counts[k] for k in keys],
                             "n_toxic": [toxic[k] for k in keys]})

    for pdf in batches:
        for text, label in zip(pdf["text"], pdf["toxic"]):
            seen = {u for w in set(TOKEN.findall(folded(text or ""))) for u in units(w)}
            counts.update(seen)
            if label >= 0.5:
                toxic.update(seen)
            if len(counts) > FLUSH:
                yield out()
                counts.clear()
                toxic.clear()
    yield out()


def _solve_lambda(s: np.ndarray, p: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1 (mean score below 0), by bisection."""
    if not (s > 0).any() or (p * s).sum() >= 0:
        return 1.0
    lo, hi = 1e-6, 1.0
    while (p * np.exp(np.minimum(hi * s, 600))).sum() < 1 and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * s, 600))).sum() < 1 else (lo, mid)
    return (lo + hi) / 2


def _fit_logistic(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps with a small ridge on binned rows: (slope >= 0, bias)."""
    beta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(60):
        prob = 1 / (1 + np.exp(-design @ beta))
        ridge = np.array([1e-2, 1e-4])
        grad = design.T @ (y - n * prob) - ridge * beta
        hess = (design * (n * prob * (1 - prob))[:, None]).T @ design + np.diag(ridge)
        step = np.clip(np.linalg.solve(hess, grad), -4, 4)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", prior: float = 0.01, test_prior: float = 0.1, z_min: float = 2.5,
        drift: float = math.log(4.0)) -> ToxicModel:
    """Learn from the labelled rows given (callers leave held-out rows out).

    ``prior``: mass of the Dirichlet prior as a share of all counts; the z scores that
    choose tokens use the heavier ``test_prior``, which asks for about a dozen texts.
    """
    lab = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y"))
           .where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id")
           .agg(F.max("y").alias("y")))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    # copies of a text count once, with their mean label
    once = (texts.select("doc_id", F.xxhash64("text").alias("h"), F.length("text").alias("n"))
            .join(lab, "doc_id").groupBy("h", "n")
            .agg(F.min("doc_id").alias("doc_id"), F.avg("y").alias("toxic"))
            .select("doc_id", "toxic"))
    counts = spool(texts.join(once, "doc_id").select("text", "toxic")
                   .mapInPandas(_count_tokens, "token string, n bigint, n_toxic bigint")
                   .groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("y1")))
    model = ToxicModel(drift=drift)
    tot = counts.agg(F.sum("n").alias("n"), F.sum("y1").alias("y1")).first()
    n, n1 = float(tot["n"] or 0), float(tot["y1"] or 0)
    n0 = n - n1
    if n1 > 0 and n0 > 0:
        def odds(share: float):
            """(log-odds, their variance, clean probability) under a prior of that share."""
            a, mass = F.lit(share) * F.col("n"), share * n
            y1, y0 = F.col("y1") + a, F.col("n") - F.col("y1") + a
            return (F.log(y1 / (F.lit(n1 + mass) - y1)) - F.log(y0 / (F.lit(n0 + mass) - y0)), 1 / y1 + 1 / y0, y0 / F.lit(n0 + mass))

        test, var, _ = odds(test_prior)
        d, _, p0 = odds(prior)
        strong = (counts.withColumn("z", F.abs(test) / F.sqrt(var)).where(F.col("z") >= z_min)
                  .orderBy(F.desc("z"), "token").select("token", d.alias("d"), p0.alias("p0")).toPandas())
        model.weights = dict(zip(strong["token"], strong["d"]))
        s = np.append(strong["d"].to_numpy() - drift, -drift)
        p = np.append(strong["p0"].to_numpy(), max(1e-9, 1 - strong["p0"].sum()))
        model.lam = _solve_lambda(s, p / p.sum())
    _calibrate(texts, lab, model)
    return model


def _calibrate(texts: DataFrame, lab: DataFrame, model: ToxicModel) -> None:
    """K from the clean rows' maxima, then the logistic curve, from all training rows."""
    scored = spool(texts.select("doc_id", segments_column(F.col("text"), model).alias("r"))
                   .select("doc_id", "r.n_tokens", "r.segments"))
    rows = scored.join(lab, "doc_id")
    best = F.array_max(F.transform("segments", lambda x: x["score"]))
    stat = rows.where((F.col("y") < 0.5) & (F.size("segments") > 0)).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.lit(model.lam) * best - F.log(F.greatest("n_tokens", F.lit(1)))).alias("m")).first()
    clean = rows.where("y < 0.5").count()
    if stat["n"] and clean:
        # texts without a segment have a maximum below the smallest score: the share
        # with one scales K, as K n exp(-lambda S) counts expected segments
        share = stat["n"] / clean
        model.k = float(np.clip(share * math.exp(stat["m"] - 0.5772156649), 1e-6, 1e6))
    ev = evidence_column(F.col("n_tokens"), F.col("segments"), model)
    bins = (rows.select(F.round(F.log1p(ev), 2).alias("x"), "y").groupBy("x")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).toPandas())
    if len(bins) and bins["y"].sum() > 0 and bins["y"].sum() < bins["n"].sum():
        model.slope, model.bias = _fit_logistic(*(bins[c].to_numpy(float) for c in ("x", "n", "y")))
    elif len(bins):
        share = 0.5 * bins["y"].sum() / bins["n"].sum()
        model.bias = math.log(share / (1 - share)) if share > 0 else -30.0


def score(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``tox`` = struct(score, evidence, passages) of every row."""
    r = docs.withColumn("tox", segments_column(F.col(text_col), model))
    ev = evidence_column(F.col("tox.n_tokens"), F.col("tox.segments"), model)
    k = F.lit(math.log(model.k)) + F.log(F.greatest(F.col("tox.n_tokens"), F.lit(1)))
    passages = F.filter(F.col("tox.segments"), lambda s: F.lit(model.lam) * s["score"] > k)
    return r.withColumn("tox", F.struct(score_column(ev, model).alias("score"), ev.alias("evidence"),
                                        passages.alias("passages")))
