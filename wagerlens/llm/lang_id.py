"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text as they stand, forwards and backwards, and
labels every byte; it is trained in numpy by backpropagation through time. A document's
probabilities are the mean of those of all its positions, over the whole text. State is
carried on from byte to byte across words.

A text is read in stretches of near ``CHUNK`` bytes, which go through the network side by
side. A direction enters a stretch with the state it has after reading the ``CONTEXT``
bytes that stand before it (for the way back: behind it) from an empty state, so every
position is labelled once and knows at least so much of its surroundings on both sides,
as far as the text goes. Work and memory follow the bytes; no task holds more than a
batch of stretches, and one document of any length is many stretches.

Defined results: a text that is null or has no letter is ``und`` with score 0; equal
probabilities go to the language that sorts first; null ids and repeated rows pass
through row by row; with no row to learn from, every text is ``und`` with score 0; an
empty table gives an empty table; input columns of the names of the results are
replaced by them, all others are passed on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm._io import held, slices, trim

#: Rows that the network learns from, and bytes of their texts, at most; a row is taken whole or not.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 8_000_000
#: Bytes of a piece of a learning text: backpropagation runs over so many steps.
PIECE = 64
#: Bytes that a stretch has about, bytes that a direction reads ahead of it, stretches that are read side by side.
CHUNK, CONTEXT, SIDE = 256, 48, 2048
#: Bytes of text that are cut at once.
BATCH_BYTES = 4_000_000

_letter = re.compile(r"[^\W\d_]").search


def side_by_side(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes (time, piece) of pieces in descending order of length, and their lengths."""
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    codes = np.zeros((len(pieces), int(lengths.max(initial=0))), dtype=np.uint8)
    codes[np.arange(codes.shape[1])[None, :] < lengths[:, None]] = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    return np.ascontiguousarray(codes.T), lengths


class ByteGru:
    """Embedding, one gated layer in each direction, and a label for each position.

    Arrays are feature first: a state is (hidden, piece), the gates are rows z, r, n.
    """

    def __init__(self, labels: list[str], params: dict[str, np.ndarray]):
        self.labels, self.p = labels, params

    @classmethod
    def fresh(cls, labels: list[str], hidden: int = 8, width: int = 8, seed: int = 7) -> ByteGru:
        r = np.random.default_rng(seed)

        def new(*shape: int) -> np.ndarray:
            return (r.standard_normal(shape) / np.sqrt(shape[-1])).astype(np.float32)

        p = {"E": new(width, 256) * 16, "Wo": new(len(labels), 2 * hidden), "bo": np.zeros(len(labels), np.float32)}
        for d in "fb":
            p |= {f"W{d}": new(3 * hidden, width), f"U{d}": new(3 * hidden, hidden), f"b{d}": np.zeros(3 * hidden, np.float32)}
        return cls(labels, p)

    @property
    def hidden(self) -> int:
        return self.p["Uf"].shape[1]

    def _given(self, d: str) -> np.ndarray:
        """What each byte gives to the gates."""
        return self.p[f"W{d}"] @ self.p["E"] + self.p[f"b{d}"][:, None]

    def states(self, codes: np.ndarray, lengths: np.ndarray, d: str, start: np.ndarray | None = None, kept: list | None = None) -> np.ndarray:
        """States (time, hidden, piece) of one direction; ``kept`` gets what the way back needs."""
        size, given, u = self.hidden, self._given(d), self.p[f"U{d}"]
        live = np.searchsorted(-lengths, -np.arange(len(codes)), side="left")  # pieces longer than t come first
        h = np.zeros((size, codes.shape[1]), given.dtype) if start is None else start.astype(given.dtype)
        out = np.zeros((len(codes), *h.shape), given.dtype)
        for t in range(len(codes)) if d == "f" else range(len(codes) - 1, -1, -1):
            n = int(live[t])
            x, before = given.take(codes[t, :n], axis=1), h[:, :n]
            a = u @ before
            gates = x[: 2 * size]
            gates += a[: 2 * size]
            gates *= 0.5
            np.tanh(gates, out=gates)  # logistic function by the hyperbolic tangent
            gates *= 0.5
            gates += 0.5
            q = a[2 * size :]
            new = gates[size:] * q
            new += x[2 * size :]
            np.tanh(new, out=new)
            now = before - new
            now *= gates[:size]
            now += new
            if kept is not None:
                kept.append((t, n, before.copy(), gates, new, q))
            out[t, :, :n] = now
            if n == h.shape[1]:
                h = now
            else:
                h = h.copy()
                h[:, :n] = now
        return out

    def _softmax(self, forth: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Label probabilities (time, label, piece) of the states of some time steps."""
        size = self.hidden
        e = self.p["Wo"][:, :size] @ forth
        e += self.p["Wo"][:, size:] @ back
        e += self.p["bo"][:, None]
        e -= e.max(axis=1, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(axis=1, keepdims=True)
        return e

    def position_probabilities(self, codes: np.ndarray, lengths: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None) -> np.ndarray:
        """Label probabilities (time, label, piece) of every position, zero past a piece's end."""
        forth, back = self.states(codes, lengths, "f", before), self.states(codes, lengths, "b", after)
        return self._softmax(forth, back) * (np.arange(len(codes))[:, None] < lengths)[:, None, :]

    def gradients(self, codes: np.ndarray, lengths: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over positions and its gradients, by backpropagation through time."""
        p, size = self.p, self.hidden
        kept: dict[str, list] = {"f": [], "b": []}
        forth, back = (self.states(codes, lengths, d, kept=kept[d]) for d in "fb")
        mask = np.arange(len(codes))[:, None] < lengths
        share = mask * weight
        share = share / share.sum()
        both = np.concatenate([forth, back], axis=1)
        flat = both.transpose(1, 0, 2).reshape(2 * size, -1)
        e = p["Wo"] @ flat + p["bo"][:, None]
        e -= e.max(axis=0)
        prob = np.exp(e)
        prob /= prob.sum(axis=0)
        at = (np.broadcast_to(target, mask.shape).ravel(), np.arange(mask.size))
        loss = float(-(np.log(prob[at] + 1e-12) * share.ravel()).sum())
        prob[at] -= 1
        prob *= share.ravel().astype(prob.dtype)
        g = {"Wo": prob @ flat.T, "bo": prob.sum(axis=1), "E": np.zeros_like(p["E"])}
        down = (p["Wo"].T @ prob).reshape(2 * size, *mask.shape).transpose(1, 0, 2)
        order = np.argsort(codes, axis=None, kind="stable")
        ranked = codes.ravel()[order]
        cuts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        for d, part in (("f", slice(0, size)), ("b", slice(size, 2 * size))):
            u, du = p[f"U{d}"], np.zeros_like(p[f"U{d}"])
            slopes = np.zeros((len(codes), 3 * size, codes.shape[1]), u.dtype)
            dh = np.zeros((size, codes.shape[1]), u.dtype)
            for t, n, h, gates, new, q in reversed(kept[d]):
                now = dh[:, :n] + down[t, part, :n]
                z, r = gates[:size], gates[size:]
                dn = now * (1 - z) * (1 - new * new)
                dz = now * (h - new) * z * (1 - z)
                dr = dn * q * r * (1 - r)
                slopes[t, :, :n] = np.concatenate([dz, dr, dn])
                inner = np.concatenate([dz, dr, dn * r])
                du += inner @ h.T
                dh[:, :n] = now * z + u.T @ inner
            by_code = slopes.transpose(0, 2, 1).reshape(-1, 3 * size)[order]
            dgiven = np.zeros((3 * size, 256), u.dtype)
            dgiven[:, ranked[cuts]] = np.add.reduceat(by_code, cuts, axis=0).T
            g[f"U{d}"], g[f"b{d}"] = du, dgiven.sum(axis=1)
            g[f"W{d}"] = dgiven @ p["E"].T
            g["E"] += p[f"W{d}"].T @ dgiven
        return loss, g

    def fit(self, pieces: list[bytes], target: np.ndarray, steps: int = 300, batch: int = 192, rate: float = 0.02, seed: int = 11) -> ByteGru:
        """Adam over random batches; classes weigh the same whatever their share."""
        r = np.random.default_rng(seed)
        share = np.bincount(target, minlength=len(self.labels)) / len(target)
        weight = (1 / np.maximum(share, 1e-6))[target]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, steps + 1):
            at = sorted(r.integers(0, len(pieces), batch).tolist(), key=lambda i: -len(pieces[i]))
            codes, lengths = side_by_side([pieces[i] for i in at])
            _, g = self.gradients(codes, lengths, target[at], weight[at])
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, x in g.items():
                x = x * scale
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x * x
                self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def text_probabilities(self, texts: list[bytes], chunk: int = CHUNK, context: int = CONTEXT, side: int = SIDE) -> np.ndarray:
        """(text, label): the mean over all positions of each text; zeros for an empty one."""
        found = [(i, lo, hi) for i, raw in enumerate(texts) for lo, hi in stretches(len(raw), chunk)]
        found.sort(key=lambda s: (s[1] - s[2], s[0], s[1]))
        sums = np.zeros((len(texts), len(self.labels)))
        for k in range(0, len(found), side):
            some = found[k : k + side]
            codes, lengths = side_by_side([texts[i][lo:hi] for i, lo, hi in some])
            entry = {}
            for d in "fb":
                around = [texts[i][max(0, lo - context) : lo] if d == "f" else texts[i][hi : hi + context] for i, lo, hi in some]
                order = sorted(range(len(some)), key=lambda j: -len(around[j]))
                led, led_lengths = side_by_side([around[j] for j in order])
                entry[d] = np.zeros((self.hidden, len(some)), np.float32)
                if len(led):
                    walked = self.states(led, led_lengths, d)
                    last = walked[led_lengths - 1, :, np.arange(len(some))] if d == "f" else walked[0].T
                    entry[d][:, order] = np.where(led_lengths > 0, last.T, 0)
            forth = self.states(codes, lengths, "f", entry["f"])
            back = self.states(codes, lengths, "b", entry["b"])
            total = np.zeros((len(self.labels), len(some)))
            for t in range(0, len(codes), 16):
                mask = (np.arange(t, min(t + 16, len(codes)))[:, None] < lengths).astype(np.float32)
                total += (self._softmax(forth[t : t + 16], back[t : t + 16]) * mask[:, None, :]).sum(axis=0)
            np.add.at(sums, [i for i, _, _ in some], total.T)
        return sums / np.maximum(1, [len(raw) for raw in texts])[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Label and pooled probability of every text."""
        probabilities = self.text_probabilities([t.encode() if t and _letter(t) else b"" for t in texts])
        best, pooled = probabilities.argmax(axis=1), probabilities.max(axis=1)
        return [self.labels[k] if s > 0 else "und" for k, s in zip(best, pooled, strict=True)], np.round(np.minimum(1, pooled), 6).tolist()


def stretches(n: int, chunk: int = CHUNK) -> list[tuple[int, int]]:
    """Cuts 0..n into stretches of near equal size, of at most ``chunk``."""
    parts = -(-n // chunk)
    edges = [n * k // parts for k in range(parts + 1)] if n else []
    return list(zip(edges, edges[1:], strict=False))


def learn(df: DataFrame, learn_rows: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES, **fit) -> ByteGru | None:
    """Train on whole texts of at most ``rows`` rows and ``most_bytes`` bytes for which ``learn_rows`` holds.

    Rows are ordered by a hash of the id. Ids and sizes are chosen first, without reading
    texts to the driver; the texts of the chosen rows are cut to pieces on the executors.
    """
    text = F.col(text_col).cast("string")
    fits = df.filter(learn_rows & F.col(lang_col).isNotNull() & text.isNotNull() & F.col(id_col).isNotNull())
    sized = fits.groupBy(id_col).agg(F.sum(F.octet_length(text)).alias("size")).filter(F.col("size") <= most_bytes)
    first = sized.orderBy(F.xxhash64(id_col), id_col).limit(rows)  # bounded by ``rows``
    before = Window.orderBy(F.xxhash64(id_col), id_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = first.withColumn("run", F.sum("size").over(before)).filter(F.col("run") <= most_bytes).select(id_col)
    read = fits.join(F.broadcast(chosen), id_col, "left_semi").select(F.col(lang_col).cast("string").alias("lang"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 1, BATCH_BYTES)):
            cut = [(lang, raw[lo:hi]) for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if _letter(t) for raw in (t.encode(),) for lo, hi in stretches(len(raw), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in cut], pa.string()), pa.array([x for _, x in cut], pa.binary())], names=["lang", "piece"])

    cut = read.mapInArrow(run, "lang string, piece binary").toArrow()
    if not cut.num_rows:
        return None
    pairs = sorted(zip(cut["lang"].to_pylist(), cut["piece"].to_pylist(), strict=True))
    labels = sorted({lang for lang, _ in pairs})
    place = {lang: k for k, lang in enumerate(labels)}
    return ByteGru.fresh(labels).fit([x for _, x in pairs], np.array([place[x] for x, _ in pairs]), **fit)


def identify(df: DataFrame, net: ByteGru | None, text_col: str = "text") -> DataFrame:
    """The columns of ``df`` and lang_pred, score. Map only, over whole texts."""
    plain = df.select(*(c for c in df.columns if c.lower() not in ("lang_pred", "score")))
    if net is None:
        return plain.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    labels, params = net.labels, net.p
    names = plain.columns
    kept = text_col in names and plain.schema[text_col].dataType.simpleString() == "string"
    read = plain if kept else plain.withColumn("__text", F.col(text_col).cast("string"))
    at = names.index(text_col) if kept else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held(("lang_id", params["Wo"].tobytes()), lambda: ByteGru(labels, params))
        for batch in (s for b in batches for s in slices(b, at, BATCH_BYTES)):
            found, scores = model.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])
        trim()

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([*plain.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return read.mapInArrow(run, schema)
