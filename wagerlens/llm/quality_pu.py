"""Quality classifier by positive-unlabelled learning.

A small network scores features of a whole text. It is trained on trusted positives
and on unlabelled rows by the non-negative unbiased risk

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with the logistic loss: the second term estimates the risk on negatives, which no row
marks, and is kept from falling below zero; a batch in which it does takes a step back
on it.

The class prior pi is estimated from positives and unlabelled rows alone. A classifier
that tells the two apart is trained on one half of each. On the other half, the share of
unlabelled rows over a threshold, divided by that of positives, bounds pi from above, as
the positives among the unlabelled alone make so many; the least of these bounds, with a
margin for the sample's size in its choice, is the estimate (clipped to 0.02..0.98).

Features are computed over the whole text: shares of classes of bytes, lengths of
words and lines, repetition of words and lines. Model state is a few hundred numbers.

Defined results: a null text is scored as an empty one; null ids and repeated rows pass
through row by row; with no positives to learn from every score is the prior 0.5; equal
texts have equal scores; an empty table gives an empty table; input columns of the
names of the results are replaced by them, all others are passed on.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm._io import slices, stage

#: Trusted positives, and unlabelled rows, that training reads at most.
SAMPLE_POSITIVES = 6_000
SAMPLE_UNLABELLED = 8_000
#: Bytes of text that are described at once.
BATCH_BYTES = 4_000_000

_CLASSES = [range(97, 123), range(65, 91), range(48, 58), (32,), (9, 10, 11, 12, 13), (44, 46, 59, 58, 39, 45), (33, 63), (35, 36, 37, 38, 42, 124, 60, 62, 61, 64, 94, 126, 95, 123, 125, 47, 92), range(128, 256)]
_CLASS_OF = np.full(256, len(_CLASSES))
for _k, _r in enumerate(_CLASSES):
    _CLASS_OF[list(_r)] = _k


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text; none grows with its length but the logs."""
    raw = (text or "").encode()
    n = len(raw)
    shares = np.bincount(_CLASS_OF[np.frombuffer(raw, dtype=np.uint8)], minlength=len(_CLASSES) + 1) / max(1, n)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    nw, nl = max(1, len(words)), max(1, len(lines))
    distinct = Counter(words)
    by_line = Counter(lines)
    top = max(distinct.values(), default=0)
    one = sum(1 for w in distinct if len(w) == 1)
    repeated = sum(len(x) * c for x, c in by_line.items() if c > 1)
    marked = sum(c for w, c in distinct.items() if not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,"))
    upper = sum(c for w, c in distinct.items() if len(w) > 1 and w.isupper())
    return [
        *np.sqrt(shares).tolist(),
        np.log1p(n) / 10,
        np.log1p(len(words)) / 10,
        np.log1p(len(lines)) / 5,
        min(30.0, n / nw) / 10,
        min(2000.0, n / nl) ** 0.5 / 20,
        len(distinct) / nw,
        len(distinct) / nw**0.75 / 2,
        len(by_line) / nl,
        repeated / max(1, n),
        top / nw,
        one / nw,
        marked / nw,
        upper / nw,
        sum(1 for w in distinct.values() if w > 1) / max(1, len(distinct)),
    ]


N_FEATURES = len(features(""))


class PuNet:
    """One hidden layer; ``mean`` and ``scale`` standardise the features."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    def _hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.clip((x - self.p["mean"]) / self.p["scale"], -8, 8)
        return x, np.tanh(x @ self.p["W"] + self.p["b"])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._hidden(x)[1] @ self.p["w"] + self.p["c"]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))

    @classmethod
    def fresh(cls, like: np.ndarray, hidden: int, r: np.random.Generator) -> PuNet:
        return cls({"mean": like.mean(0), "scale": like.std(0) + 1e-3, "W": r.standard_normal((like.shape[1], hidden)) / np.sqrt(like.shape[1]), "b": np.zeros(hidden), "w": r.standard_normal(hidden) / np.sqrt(hidden), "c": np.zeros(1)})

    def _back(self, x: np.ndarray, h: np.ndarray, d: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients from the slopes ``d`` of the logits."""
        inner = np.outer(d, self.p["w"]) * (1 - h * h)
        return {"w": h.T @ d, "c": np.array([d.sum()]), "W": x.T @ inner, "b": inner.sum(0)}

    def risk(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float, dict[str, np.ndarray]]:
        """(risk of positives, estimated risk of negatives, direction of descent).

        While the second is not below zero the direction is the gradient of their sum,
        else that of the second, turned round.
        """
        (xp, hp), (xu, hu) = self._hidden(positive), self._hidden(unlabelled)
        gp, gu = hp @ self.p["w"] + self.p["c"], hu @ self.p["w"] + self.p["c"]
        n, m = len(gp), len(gu)
        # logistic loss l(t) = log(1 + exp(-t))
        right = prior * np.logaddexp(0, -gp).mean()
        wrong = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        as_positive, as_negative, unknown = -1 / (1 + np.exp(gp)), 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        if wrong >= 0:
            dp, du = prior * (as_positive - as_negative) / n, unknown / m
        else:
            dp, du = prior * as_negative / n, -unknown / m
        p, u = self._back(xp, hp, dp), self._back(xu, hu, du)
        return float(right), float(wrong), {k: p[k] + u[k] for k in p}

    def apart(self, positive: np.ndarray, unlabelled: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss of telling positives from unlabelled rows, both weighing the same, and its gradient."""
        (xp, hp), (xu, hu) = self._hidden(positive), self._hidden(unlabelled)
        gp, gu = hp @ self.p["w"] + self.p["c"], hu @ self.p["w"] + self.p["c"]
        p, u = self._back(xp, hp, -1 / (1 + np.exp(gp)) / len(gp)), self._back(xu, hu, 1 / (1 + np.exp(-gu)) / len(gu))
        return float(np.logaddexp(0, -gp).mean() + np.logaddexp(0, gu).mean()), {k: p[k] + u[k] for k in p}

    def _descend(self, slope, steps: int, rate: float, decay: float = 1e-4) -> PuNet:
        """Adam with weight decay on what ``slope`` gives."""
        p, m, v = self.p, {}, {}
        for step in range(1, steps + 1):
            for k, d in slope().items():
                d = d + decay * p[k] * (k in "Ww")
                m[k] = 0.9 * m.get(k, 0) + 0.1 * d
                v[k] = 0.999 * v.get(k, 0) + 0.001 * d * d
                p[k] -= rate * (1 - 0.9 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    @classmethod
    def fit(cls, positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 12, steps: int = 1500, batch: int = 512, rate: float = 0.01, seed: int = 5) -> PuNet:
        r = np.random.default_rng(seed)
        net = cls.fresh(unlabelled, hidden, r)
        return net._descend(lambda: net.risk(positive[r.integers(0, len(positive), batch)], unlabelled[r.integers(0, len(unlabelled), batch)], prior)[2], steps, rate)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, hidden: int = 8, steps: int = 500, batch: int = 512, doubt: float = 0.1, seed: int = 9) -> float:
    """Share of positives among unlabelled rows, from the two samples alone."""
    r = np.random.default_rng(seed)
    half = [r.permutation(len(x)) % 2 == 0 for x in (positive, unlabelled)]
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    xp, xu = positive[half[0]], unlabelled[half[1]]
    net = PuNet.fresh(xu, hidden, r)
    net._descend(lambda: net.apart(xp[r.integers(0, len(xp), batch)], xu[r.integers(0, len(xu), batch)])[1], steps, 0.01)
    return least_bound(net.scores(positive[~half[0]]), net.scores(unlabelled[~half[1]]), doubt)


def least_bound(positive: np.ndarray, unlabelled: np.ndarray, doubt: float) -> float:
    """The least ratio of shares over a threshold, chosen by its upper confidence limit."""
    cuts = np.unique(positive)
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    margin = sum(np.sqrt(np.log(4 / doubt) / (2 * n)) for n in (len(positive), len(unlabelled)))
    best = np.argmin((u + margin) / p)
    return float(np.clip(u[best] / p[best], 0.02, 0.98))


def learn(docs: DataFrame, labels: DataFrame, learn_rows: Column, positives: int = SAMPLE_POSITIVES, unlabelled: int = SAMPLE_UNLABELLED, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", prior: float | None = None, **fit) -> PuNet | None:
    """Train on bounded samples, the least ids by a hash; ids are chosen before texts are read.

    Trusted positives are labelled 1 in the learning folds. The unlabelled sample is of
    all rows of those folds, whatever their label. Features are computed on the
    executors, and only they come to the driver. ``prior`` takes the estimate's place.
    """
    known = labels.filter(F.col(id_col).isNotNull()).filter(learn_rows)

    def least(rows: DataFrame, n: int, mark: str) -> DataFrame:
        return rows.select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(n).select(F.col(id_col).cast("long").alias("id"), F.lit(True).alias(mark))

    trusted = least(known.filter(F.col(label_col) == 1), positives, "trusted")
    web = least(docs.filter(F.col(id_col).isNotNull()).filter(learn_rows), unlabelled, "web")
    chosen = stage(trusted.join(web, "id", "full"), "quality-sample")  # bounded by the two samples
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id")
    got = _described(read).toArrow()
    x = np.array(got["x"].to_pylist(), dtype=np.float64).reshape(-1, N_FEATURES)
    order = np.lexsort([*x.T[::-1], np.asarray(got["id"])])
    marks = [np.array([bool(v) for v in got[k].to_pylist()], dtype=bool)[order] for k in ("trusted", "web")]
    xp, xu = x[order][marks[0]], x[order][marks[1]]
    if not len(xp) or not len(xu):
        return None
    return PuNet.fit(xp, xu, estimated_prior(xp, xu) if prior is None else prior, **fit)


def _described(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 1, BATCH_BYTES)):
            x = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(x, pa.list_(pa.float64()))], names=["id", "trusted", "web", "x"])

    return df.select("id", "text", "trusted", "web").mapInArrow(run, "id long, trusted boolean, web boolean, x array<double>")


def score(df: DataFrame, net: PuNet | None, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The columns of ``df``, then score and predicted. Map only, over whole texts."""
    plain = df.select(*(c for c in df.columns if c.lower() not in ("score", "predicted")))
    if net is None:
        return plain.withColumns({"score": F.lit(0.5), "predicted": F.lit(int(threshold <= 0.5))})
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    params, names = net.p, plain.columns
    kept = text_col in names and plain.schema[text_col].dataType.simpleString() == "string"
    read = plain if kept else plain.withColumn("__text", F.col(text_col).cast("string"))
    at = names.index(text_col) if kept else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PuNet(params)
        for batch in (s for b in batches for s in slices(b, at, BATCH_BYTES)):
            s = np.round(model.scores(np.array([features(t) for t in batch.column(at).to_pylist()])), 6)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    schema = StructType([*plain.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return read.mapInArrow(run, schema)
