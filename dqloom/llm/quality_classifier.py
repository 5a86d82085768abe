"""Quality classifier: naive Bayes features in a linear support vector machine.

Features are indicators of the byte trigrams of a text and of words that repeat the one before,
hashed to ``DIMENSIONS``. Each is scaled by its log-count ratio between the classes, the
vector is brought to length one, and a linear model with hinge loss is fitted by dual coordinate
descent, the classes weighted to count alike. A logistic curve turns margins into scores; it is
fitted on margins of rows that the model behind them did not see.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, those with the least hash of their
doc_id, so what one task holds for the fit is bounded; every text is scored, whole. Only labels of
rows outside the held-out fold are read. Only ids and labels of the sample are broadcast, then a
model of ``DIMENSIONS`` numbers.

In every case: no text or an empty one has no feature and gets the score of the bias alone; labels
with a missing doc_id or quality are left out; of repeated labels of a doc_id the largest counts;
without any label, or with one class only, every score is 0.5; extra columns are passed on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm import common as c

DIMENSIONS = 1 << 17
TRAIN_ROWS = 6000
FOLDS = 5
EPOCHS = 12
COST = 1.0
SMOOTH = 1.0
THRESHOLD = 0.3
# Parts of the training rows; the margins of each come from a fit on the others.
PARTS = 4
# Shares of words that repeat the one before, each with a feature of its own.
REPEATS = (0.0, 0.05, 0.2, 0.5)
WIDTH = DIMENSIONS + len(REPEATS)


def fold(doc_id: str | Column = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def features(text: bytes) -> np.ndarray:
    """Sorted numbers of the features of a text."""
    flags = np.zeros(WIDTH, np.uint8)
    if text:
        b = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint32)
        grams = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        flags[(grams * np.uint32(2654435761)) >> np.uint32(15)] = 1
        words = text.split()
        same = sum(a == b for a, b in zip(words, words[1:]))
        # the share of repeated words, in steps
        for step, share in enumerate(REPEATS):
            flags[DIMENSIONS + step] = same > share * len(words)
    return np.flatnonzero(flags)


def fit(rows: list[tuple[np.ndarray, int]]) -> dict | None:
    """A model from (features, label) pairs in a fixed order.

    The curve is fitted on margins of rows that the model behind them did not see, so few
    rows do not make it too sure of itself.
    """
    labels = np.array([y for _, y in rows])
    margins, seen = np.zeros(len(rows)), np.zeros(len(rows), bool)
    numbers = np.arange(len(rows))
    # parts take turns within each class, so all have some rows of both
    part = np.zeros(len(rows), np.int64)
    for y in (0, 1):
        part[labels == y] = np.arange((labels == y).sum()) % PARTS
    for p in range(PARTS):
        fitted = _descend(rows, numbers[part != p])
        if fitted is not None:
            for i in numbers[part == p].tolist():
                margins[i], seen[i] = _margin(rows[i][0], *fitted), True
    fitted = _descend(rows, numbers)
    if fitted is None:
        return None
    if not seen.any():
        margins, seen = np.array([_margin(at, *fitted) for at, _ in rows]), ~seen
    ratio, weights, bias = fitted
    slope, offset = _curve(margins[seen], labels[seen])
    return {"ratio": ratio.astype(np.float32), "weights": weights.astype(np.float32), "bias": bias, "slope": slope, "offset": offset}


def _margin(at: np.ndarray, ratio: np.ndarray, weights: np.ndarray, bias: float) -> float:
    x = ratio[at]
    return float(weights[at] @ x) / max(float(np.linalg.norm(x)), 1e-12) + bias


def _descend(rows: list[tuple[np.ndarray, int]], train: np.ndarray) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Log-count ratios, weights and bias fitted on the rows numbered ``train``."""
    train = train.tolist()
    shares = np.bincount([rows[i][1] for i in train], minlength=2)
    if 0 in shares:
        return None
    counts = {y: np.full(WIDTH, SMOOTH) for y in (0, 1)}
    for i in train:
        counts[rows[i][1]][rows[i][0]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    vectors = {}
    for i in train:
        x = ratio[rows[i][0]]
        vectors[i] = x / max(np.linalg.norm(x), 1e-12)
    cost = COST * len(train) / (2 * shares)
    weights, bias = np.zeros(WIDTH), 0.0
    alpha = dict.fromkeys(train, 0.0)
    order = np.random.RandomState(1)
    for _ in range(EPOCHS):
        for i in order.permutation(train).tolist():
            at, y = rows[i]
            sign = 2 * y - 1
            x = vectors[i]
            # the bias is one more feature, of value 1
            slope = sign * (weights[at] @ x + bias) - 1
            now = min(max(alpha[i] - slope / (x @ x + 1), 0.0), cost[y])
            if now != alpha[i]:
                step = (now - alpha[i]) * sign
                weights[at] += step * x
                bias += step
                alpha[i] = now
    return ratio, weights, bias


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a small penalty.

    As in the descent, the classes are weighted to count alike.
    """
    up, down = labels.sum(), (1 - labels).sum()
    weight = len(labels) / (2 * np.maximum(np.where(labels == 1, up, down), 1))
    goal = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    design = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (p - goal)) + 1e-3 * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score(text: bytes, model: dict | None) -> float:
    if model is None:
        return 0.5
    margin = _margin(features(text), model["ratio"], model["weights"], model["bias"])
    return float(1 / (1 + np.exp(-np.clip(model["slope"] * margin + model["offset"], -30, 30))))


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict | None:
    """A model from the labels outside the held-out fold; None if they don't tell two classes."""
    sample = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .where(fold() != 0)
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    known = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id")

    def look(frames):
        for frame in frames:
            packed = [features(t or b"").astype(np.int32).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": frame["quality"], "at": packed})

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(c.mixed(group["doc_id"].to_numpy().astype(np.int64).view(c.U64)), kind="stable")
        group = group.iloc[order]
        model = fit([(np.frombuffer(a, np.int32), int(y)) for a, y in zip(group["at"], group["quality"])])
        if model is None:
            return pd.DataFrame({"ratio": [], "weights": [], "bias": [], "slope": [], "offset": []})
        return pd.DataFrame([{k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in model.items()}])

    # one text of each doc_id reaches the fit, however often a row is repeated
    one = known.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("text").alias("text"))
    seen = one.mapInPandas(look, "doc_id long, quality int, at binary")
    found = seen.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "ratio binary, weights binary, bias double, slope double, offset double").collect()
    if not found:
        return None
    row = found[0].asDict()
    return row | {k: np.frombuffer(row[k], np.float32) for k in ("ratio", "weights")}


def scored(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with a struct ``quality``: ``held_out``, ``score``, ``predicted``."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, doc_id = (f"c{names.index(n)}" for n in ("text", "doc_id"))
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs.select("doc_id", "text"), labels, rows))
    marked = plain.withColumn("score", F.lit(None).cast("double"))

    def judge(frames):
        model = sent.value
        for frame in frames:
            frame["score"] = [score(t.encode() if isinstance(t, str) else t or b"", model) for t in frame[text]]
            yield frame

    result = F.struct(
        F.coalesce(fold(doc_id) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
    return marked.mapInPandas(judge, marked.schema).select(*plain.columns, result.alias("quality")).transform(c.under, names, "quality")
