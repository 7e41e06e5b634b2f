"""A quality classifier learned from trusted positives and unlabelled text.

The linear model minimises the non-negative unbiased risk of positive-unlabelled learning: with class prior q,
logistic loss L and score g,

    q * mean_P L(g)  +  max(0, mean_U L(-g) - q * mean_P L(-g)).

The second part is the risk on the negatives, which no label names; below zero the model would fit the sample, so
steps end at zero and go on along that border. As L(g) - L(-g) = -g, the whole is -q * mean_P g + mean_U L(-g) where
the second part counts, which is convex: Newton steps find its least value, and each needs one read of all unlabelled
rows, summed where they lie. Scores are sigmoid(g).
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.common import id_text, raw, to_batches
from larkspur.session import scratch_path

FIT_ROWS = 20_000  # bound of the positives, whose ids are broadcast
DECAY = 1e-2  # set on training rows split once more: 1e-3 to 3e-2 do alike
TOLERANCE = 1e-4
BORDER = 10.0  # weight of a negative part below zero, against the risk, when a step is judged
SUMS = pa.schema([("v", pa.list_(pa.float64()))])
PUNCTUATION = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
N_FEATURES = len(PUNCTUATION) + 10


def features(text: bytes) -> np.ndarray:
    """Shares of the text that say how it is written, not what it is about; an empty text gives zeros."""
    out = np.zeros(N_FEATURES)
    if not text:
        return out
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, k = len(text), len(PUNCTUATION)
    words, lines = text.split(), text.split(b"\n")
    letters = count[65:91].sum() + count[97:123].sum() + count[128:].sum()
    out[:k] = np.tanh(20.0 * count[PUNCTUATION] / n)
    out[k] = count[65:91].sum() / max(1, letters)
    out[k + 1] = count[48:58].sum() / n
    out[k + 2] = letters / n
    out[k + 3] = count[128:].sum() / n
    out[k + 4] = (count[:32].sum() - count[10]) / n
    out[k + 5] = np.tanh(20.0 * count[10] / n)
    if words:
        out[k + 6] = sum(map(eq, words, words[1:])) / len(words)
        out[k + 7] = 1 - len(set(words)) / len(words)
        out[k + 8] = np.tanh((n - len(words)) / len(words) / 20)
    out[k + 9] = 1 - len(set(lines)) / len(lines)
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        x = np.array([features(t) for t in texts]).reshape(-1, N_FEATURES)
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.scale @ self.weight + self.bias, -500, 500)))

    def column(self, text: Column) -> Column:
        """The score of a text column: 0 to 1, null and empty texts too."""

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            return pa.array(self.score(raw(texts)), pa.float64())

        return score(text.cast("string"))


def moments(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Rows, positives among them, and sums of x, of x squared and of the positives' x."""
    return np.concatenate([[len(x), p.sum()], x.sum(0), (x * x).sum(0), p @ x])


def risk_sums(x: np.ndarray, p: np.ndarray, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Sums of L(-g) over the rows and over the positives among them, the slopes of both, the curvature of the first."""
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    g = z @ w
    loss, up = np.logaddexp(0, g), 1 / (1 + np.exp(-np.clip(g, -500, 500)))
    return np.concatenate([[loss.sum(), p @ loss], up @ z, (p * up) @ z, ((z * (up * (1 - up))[:, None]).T @ z).ravel()])


def least_risk(sums: Callable[..., np.ndarray], prior: float, n: int, rounds: int = 60, tol: float = TOLERANCE) -> Model | None:
    """The linear model of `n` features of least non-negative risk, to where a step lowers it by less than `tol`. `sums(f, *args)` adds up f(x, p, *args) over all
    unlabelled rows, p being 1 for a positive. None if there are no rows or no positives."""
    got = sums(moments)
    if not len(got) or not got[1]:
        return None
    rows, known = got[:2]
    mean = got[2 : 2 + n] / rows
    scale = np.sqrt(np.maximum(got[2 + n : 2 + 2 * n] / rows - mean**2, 0)) + 0.01
    pull = prior * np.append((got[2 + 2 * n :] / known - mean) / scale, 1.0)
    w, share, best, small = np.zeros(n + 1), 1.0, None, DECAY * np.eye(n + 1)
    for _ in range(rounds):
        s = sums(risk_sums, w, mean, scale)
        all_slope, known_slope = s[2 : 3 + n] / rows, s[3 + n : 4 + 2 * n] / known
        negatives = s[0] / rows - prior * s[1] / known
        risk = s[0] / rows - pull @ w + DECAY / 2 * w @ w + BORDER * max(0.0, -negatives)
        if best is None or risk <= best[0]:
            gain, best, share = np.inf if best is None else best[0] - risk, (risk, w), 1.0
            curve, slope, edge = s[4 + 2 * n :].reshape(n + 1, n + 1) / rows + small, all_slope - pull + DECAY * w, all_slope - prior * known_slope
            free, lift = np.linalg.solve(curve, np.stack([slope, edge], 1)).T
            step = free - lift * max(0.0, (edge @ free - negatives) / max(edge @ lift, 1e-12))  # negatives - edge @ step >= 0
            if gain < tol or step @ curve @ step < 1e-9:
                break
        else:
            share /= 2
            if share < 1e-3:
                break
        w = best[1] - share * step
    else:
        warnings.warn(f"the risk had not settled after {rounds} steps", stacklevel=2)
    return Model(mean, scale, best[1][:-1], float(best[1][-1]))


def _summed(rows: DataFrame) -> Callable[..., np.ndarray]:
    """`sums` of `least_risk` over a table (p, x): a task adds up its own rows, then sums are added by place."""

    def sums(f: Callable[..., np.ndarray], *args: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                if b.num_rows:
                    x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
                    got = f(x, b.column(0).to_numpy(zero_copy_only=False).astype(np.float64), *args)
                    total = got if total is None else total + got
            if total is not None:
                yield from to_batches(SUMS, [[[total.tolist()]]])

        parts = rows.select("p", "x").mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "v"))
        return np.array([v for _, v in sorted(map(tuple, parts.groupBy("i").agg(F.sum("v")).collect()))])  # a row a place

    return sums


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """Learn from `labels` (id, label 0/1) on rows that aren't held out.

    Every row of `docs` that isn't held out is unlabelled, rows without an id too. Positives are those among them
    whose id is labelled 1, of at most `fit_rows` such ids, those of least hash, which are broadcast; the class prior
    is the mean label, over all labels given. Repeated labels count once per row in the prior, null labels and ids not
    at all. The features go to the shared folder once. Without positives or texts every score is the prior (one
    half if there are no labels).
    """
    src = id_text(docs, id_col, text_col)
    told = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
    pos = told.where("y = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)

    @F.arrow_udf("array<float>")
    def extract(texts: pa.Array) -> pa.Array:
        return pa.array([features(t).astype(np.float32) for t in raw(texts)], pa.list_(pa.float32()))

    named = src.where(~held_out(F.col("doc_id"))).join(F.broadcast(pos.withColumn("p", F.lit(1))), "doc_id", "left")
    path = scratch_path(docs.sparkSession, "quality")
    named.select(F.coalesce("p", F.lit(0)).alias("p"), extract("text").alias("x")).write.parquet(path)
    prior = told.agg(F.avg("y")).first()[0]
    q = min(max(0.5 if prior is None else prior, 1e-6), 1 - 1e-6)
    model = least_risk(_summed(docs.sparkSession.read.parquet(path)), q, N_FEATURES)
    return model or Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), float(np.log(q / (1 - q))))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row: whole texts, null as empty; repeated rows score
    alike, a null id counts as not held out, an empty table gives an empty result, other columns are not read."""
    src = id_text(docs, id_col, text_col)
    scored = src.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
