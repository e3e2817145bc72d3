"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's features are its own and those of
its neighbours; the chain adds weights between the labels of lines that follow
each other. A document's score is the mean of the forward-backward marginals
of "good", weighted by the lines' lengths.

The field is fitted on a bounded sample of labelled documents, whose lines take
their document's label; scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shipped, stage

#: Labelled documents that a fit may take.
SAMPLE = 4000
#: Lines that a fit may take.
SAMPLE_LINES = 300_000
OWN = 10
WIDTH = 1 + 2 * OWN

_CLASS = np.zeros(0x180, dtype=np.uint8)
for _k in range(0x180):
    _c = chr(_k)
    _CLASS[_k] = (1 if _c.isupper() else 2 if _c.isalpha() else 3 if _c.isdigit() else
                  4 if _c in "#*$%&|<>" else 5 if _c == "!" else 6 if _c in ".,;:?" else 0)


def _bent(rate: np.ndarray, half: float) -> np.ndarray:
    """A rate's square bent to 0..1, one half at ``half``: few are as none, many as all."""
    return rate ** 2 / (rate ** 2 + half ** 2)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x WIDTH) and lengths of the lines of a text; a line holds at least one word."""
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    n = len(lines)
    own = np.zeros((n, OWN))
    if not n:
        return np.zeros((0, WIDTH)), np.zeros(0)
    sizes = np.array([len(x) for x in lines])
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = _CLASS[np.minimum(code, len(_CLASS) - 1)]
    at = np.zeros(n, dtype=np.int64)
    np.cumsum(sizes[:-1], out=at[1:])
    upper, lower, digit, symbol, bang, mark = (
        np.add.reduceat(kind == k, at, dtype=np.int64) for k in range(1, 7))
    seen: set[str] = set()
    counts = np.zeros((n, 3))
    for k, line in enumerate(lines):
        words = line.split()
        counts[k] = len(words), sum(map(eq, words, words[1:])), line in seen
        seen.add(line)
    words = np.maximum(counts[:, 0], 1)
    letters = np.maximum(upper + lower, 1)
    own[:, 0] = _bent(upper / letters, 0.3)
    own[:, 1] = _bent(symbol / words, 0.1)
    own[:, 2] = _bent(bang / words, 0.1)
    own[:, 3] = digit / np.maximum(sizes, 1)
    own[:, 4] = _bent(counts[:, 1] / words, 0.1)
    own[:, 5] = counts[:, 2]
    own[:, 6] = np.minimum(mark / words, 2)
    own[:, 7] = np.log1p(words) / 5
    own[:, 8] = np.minimum(sizes / words, 30) / 10
    own[:, 9] = words < 3
    near = np.zeros_like(own)
    near[1:] += own[:-1]
    near[:-1] += own[1:]
    beside = np.full((n, 1), 2.0)
    beside[0] -= 1
    beside[-1] -= 1
    near /= np.maximum(beside, 1)
    return np.hstack([np.ones((n, 1)), own, near]), sizes.astype(float)


class Chain:
    """Weights of a two-label linear chain; label 1 is "good"."""

    def __init__(self, weight: np.ndarray, step: np.ndarray, prior: float):
        self.weight, self.step, self.prior = weight, step, prior

    def marginals(self, lines: np.ndarray) -> np.ndarray:
        """P(good) of each line: forward and backward passes in the odds of the two labels."""
        n = len(lines)
        emit = np.exp(np.clip(lines @ self.weight, -30, 30)).tolist()
        (a, b), (c, d) = np.exp(self.step).tolist()
        ahead = [0.0] * n
        odds = ahead[0] = emit[0]
        for t in range(1, n):
            odds = ahead[t] = emit[t] * (b + d * odds) / (a + c * odds)
        out = np.array(ahead)
        back = [1.0] * n
        r = 1.0
        for t in range(n - 1, 0, -1):
            r *= emit[t]
            r = back[t - 1] = (c + d * r) / (a + b * r)
        out *= back
        return out / (1 + out)

    def score(self, text: str | None) -> float:
        lines, sizes = line_features(text or "")
        if not len(sizes):
            return self.prior
        return float(np.clip(self.marginals(lines) @ sizes / sizes.sum(), 0, 1))


def _gradient(weight, step, lines, label, starts, doc_of, n_docs, longest, pad):
    """Log-likelihood and its gradient over all documents at once; pad: line number by (position, document)."""
    score = lines @ weight
    here = pad >= 0
    s1 = np.where(here, score[np.maximum(pad, 0)], 0.0)
    alpha = np.zeros((longest, n_docs, 2))
    alpha[0, :, 1] = s1[0]
    for t in range(1, longest):
        prev = alpha[t - 1][:, :, None] + step[None]
        top = prev.max(1)
        nxt = top + np.log(np.exp(prev - top[:, None]).sum(1))
        nxt[:, 1] += s1[t]
        alpha[t] = np.where(here[t][:, None], nxt, alpha[t - 1])
    top = alpha[-1].max(1)
    logz = top + np.log(np.exp(alpha[-1] - top[:, None]).sum(1))
    beta = np.zeros((longest, n_docs, 2))
    pair = np.zeros((2, 2))
    for t in range(longest - 1, 0, -1):
        on = here[t]
        after = beta[t].copy()
        after[:, 1] += s1[t]
        both = step[None] + after[:, None, :]
        joint = np.exp(alpha[t - 1][:, :, None] + both - logz[:, None, None])
        pair += joint[on].sum(0)
        top = both.max(2)
        back = top + np.log(np.exp(both - top[:, :, None]).sum(2))
        beta[t - 1] = np.where(on[:, None], back, beta[t])
    p1 = np.exp(alpha[:, :, 1] + beta[:, :, 1] - logz)
    prob = np.zeros(len(lines))
    prob[pad[here]] = p1[here]
    follow = np.ones(len(lines), dtype=bool)
    follow[starts] = False
    same = label[follow]
    told = np.array([[np.sum(same == 0), 0], [0, np.sum(same == 1)]], dtype=float)
    gain = (score * label).sum() + (told * step).sum() - logz.sum()
    return gain, lines.T @ (label - prob), told - pair


def fit(samples: list[tuple[np.ndarray, int]], rounds: int = 200, ridge: float = 1e-4) -> Chain:
    """Fit by Adam on the penalised log-likelihood; samples: features and label of each document."""
    samples = sorted((s for s in samples if len(s[0])), key=lambda s: len(s[0]))
    labels = [y for _, y in samples]
    prior = float(np.mean(labels)) if labels else 0.5
    weight, step = np.zeros(WIDTH), np.zeros((2, 2))
    if not samples:
        return Chain(weight, step, prior)
    packs = []
    for k in range(0, len(samples), 500):
        part = samples[k:k + 500]
        sizes = np.array([len(f) for f, _ in part])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        pad = np.full((sizes.max(), len(part)), -1)
        for d, (a, n) in enumerate(zip(starts, sizes)):
            pad[:n, d] = np.arange(a, a + n)
        packs.append((np.vstack([f for f, _ in part]), np.repeat([y for _, y in part], sizes).astype(float),
                      starts, None, len(part), int(sizes.max()), pad))
    total = sum(len(p[0]) for p in packs)
    theta = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        grad = -ridge * theta
        for p in packs:
            _, gw, gs = _gradient(theta[:WIDTH], theta[WIDTH:].reshape(2, 2), *p)
            grad += np.concatenate([gw, gs.ravel()]) / total
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad ** 2
        theta += 0.2 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return Chain(theta[:WIDTH], theta[WIDTH:].reshape(2, 2), prior)


def held_out(id_col: Column) -> Column:
    """Rows that no fit may see: crc32 of the id as text divisible by 5 (null ids too)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Chain:
    """Fit on at most ``sample`` labelled documents, those with the least hash of their id.

    Features are computed by the executors and written; the driver gets the line counts of the
    sample, then the features of at most SAMPLE_LINES lines. A document with more lines than are
    left is passed over in the fit (not in scoring).
    """
    known = labels.where(~held_out(F.col(id_col)) & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("known_id"), F.col(label_col).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("known_id"), "known_id", "y").limit(sample)
    rows = shipped(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(known), F.col("id") == F.col("known_id")).select("id", "y", "text")

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: line_features(t or "")[0].astype("<f4").tobytes())

    picked = rows.select("id", "y", features("text").alias("x")).orderBy(
        F.xxhash64("id"), "id", "y", F.xxhash64("x")).limit(sample)
    picked = stage(picked.select(F.monotonically_increasing_id().alias("at"), "y", "x"))
    # Lines are counted before any feature is sent: a document that no longer fits is passed over.
    chosen, left = [], SAMPLE_LINES
    for r in picked.select("at", (F.octet_length("x") / (4 * WIDTH)).cast("long").alias("n")).orderBy("at").collect():
        if r["n"] <= left:
            chosen.append(r["at"])
            left -= r["n"]
    held = picked.where(F.col("at").isin(chosen)).orderBy("at").collect() if chosen else []
    return fit([(np.frombuffer(r["x"], dtype="<f4").reshape(-1, WIDTH).astype(float), r["y"]) for r in held])


def scorer(chain: Chain):
    """A column function from texts to scores; texts without a line get the share of label 1 in the fit."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(chain.score).astype(float)

    return score


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null and empty texts are scored too. Repeated rows get equal scores, null
    ids count as held out, and no other column of the input is read.
    """
    score = scorer(train(docs, labels, id_col, text_col))
    return docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
        score(F.col(text_col)).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
