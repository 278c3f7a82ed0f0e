"""Quality of whole texts by attention over their passages.

A text is a bag of passages of PASSAGE bytes. Each is described by how its kinds of characters follow each
other and how its words repeat, and encoded by a learned layer. A gated attention, learned together with it
from labels of whole documents, weighs the passages; the weighted mean gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import fold, kept_where, labelled_sample, release, slices, texts_of

PASSAGE = 512
#: The model is fitted on at most so many labelled documents with at most so many bytes of text; it sees all their passages.
MODULUS, HELD_OUT, SAMPLE_ROWS, SAMPLE_BYTES, THRESHOLD = 5, 0, 5_000, 32_000_000, 0.3
#: Bytes after which a text is described anew, so that long texts need no more memory than short ones; a multiple of PASSAGE.
PORTION = 1_048_576
HIDDEN, GATE, STEPS, RATE, DECAY, SEED = 16, 8, 250, 0.03, 1e-4, 7
_KINDS = np.zeros(256, np.uint8)
for _k, _bytes in enumerate((b"\n\r\x0b\x0c", b" \t", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b".,;:", b"!?", b"|", b"'\"()[]{}", b"*#$%&@^~_=+-<>/\\`", bytes(range(128, 256))), 1):
    _KINDS[list(_bytes)] = _k
KINDS = 12
FEATURES = KINDS * KINDS + 6


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, one text after another, and how many each text has; an empty text has one."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1  # a line feed ends each text
    counts = np.maximum(1, -(-(sizes - 1) // PASSAGE))
    total = int(counts.sum())
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    starts = np.cumsum(sizes) - sizes
    first = np.cumsum(counts) - counts
    within = np.arange(len(data)) - np.repeat(starts, sizes)
    owner = np.minimum(within // PASSAGE, np.repeat(counts - 1, sizes)) + np.repeat(first, sizes)
    kind = _KINDS[data].astype(np.int64)
    own = np.ones(len(data), bool)  # the last line feed of a text has no follower
    own[starts[1:] - 1] = own[-1:] = False
    at = np.flatnonzero(own)
    pairs = np.bincount(owner[at] * KINDS * KINDS + kind[at] * KINDS + kind[at + 1], minlength=total * KINDS * KINDS).reshape(total, -1)
    out = np.zeros((total, FEATURES), np.float32)
    out[:, : KINDS * KINDS] = pairs / np.maximum(1, pairs.sum(1, keepdims=True))
    blank = (kind == 1) | (kind == 2)
    begins = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    words = np.fromiter(map(hash, data.tobytes().split()), np.int64, len(begins))
    home = owner[begins]
    n = np.maximum(1, np.bincount(home, minlength=total))
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (home[1:] == home[:-1])
    order = np.lexsort((words, home))
    repeat = np.zeros(len(words), bool)
    repeat[1:] = (words[order][1:] == words[order][:-1]) & (home[order][1:] == home[order][:-1])
    ends = np.flatnonzero(~blank & np.append(blank[1:], True))
    length = (ends - begins + 1).astype(np.float64)
    mean = np.bincount(home, length, total) / n
    out[:, -6] = np.bincount(home[same], minlength=total) / n
    out[:, -5] = np.bincount(home[order][repeat], minlength=total) / n
    out[:, -4] = mean / 10
    out[:, -3] = np.sqrt(np.maximum(0, np.bincount(home, length * length, total) / n - mean * mean)) / 10
    out[:, -2] = np.bincount(home[np.isin(kind[ends], (7, 8, 10))], minlength=total) / n
    out[:, -1] = np.log1p(n) / 5
    return out, counts


def portions(text: bytes) -> list[bytes]:
    """The text in runs of PORTION bytes, each described on its own: a word across their edge counts as two."""
    return [text[k : k + PORTION] for k in range(0, len(text), PORTION)] or [b""]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Encoder, gated attention and output weights; plain arrays, so it travels with a task."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: dict[str, np.ndarray]):
        self.mean, self.spread, self.w = mean, spread, weights

    @classmethod
    def fit(cls, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> AttentionModel:
        """Adam on the mean log loss over all bags at once; sizes[k] passages of x make bag k of label y[k]."""
        draw = np.random.default_rng(SEED)
        mean, spread = x.mean(0), x.std(0) + 0.02
        shapes = {"enc": (FEATURES, HIDDEN), "enc0": (HIDDEN,), "tan": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "att": (GATE,), "out": (HIDDEN,), "out0": (1,)}
        w = {k: draw.normal(0, 1 / np.sqrt(s[0]), s) if k not in ("enc0", "out0") else np.zeros(s) for k, s in shapes.items()}
        share = np.clip(y.mean(), 0.02, 0.98)
        w["out0"][:] = np.log(share / (1 - share))
        self = cls(mean, spread, w)
        x = ((x - mean) / spread).astype(np.float32)
        starts, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            grad = self._gradient(x, starts, of, y)
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for k, g in grad.items():
                g = g + DECAY * w[k] * (k != "out0")
                m1[k] += 0.1 * (g - m1[k])
                m2[k] += 0.01 * (g * g - m2[k])
                w[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def _gradient(self, x, starts, of, y) -> dict[str, np.ndarray]:
        w = self.w
        h = np.tanh(x @ w["enc"].astype(np.float32) + w["enc0"]).astype(np.float64)
        t, g = np.tanh(h @ w["tan"]), _sigmoid(h @ w["gate"])
        a = self._attention((t * g) @ w["att"], starts, of)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        d = (_sigmoid(z @ w["out"] + w["out0"]) - y) / len(y)
        dz = d[:, None] * w["out"]
        da = (dz[of] * h).sum(1)
        ds = a * (da - np.add.reduceat(a * da, starts)[of])
        dt, dg = ds[:, None] * w["att"] * g * (1 - t * t), ds[:, None] * w["att"] * t * g * (1 - g)
        dh = (a[:, None] * dz[of] + dt @ w["tan"].T + dg @ w["gate"].T) * (1 - h * h)
        return {"enc": x.T @ dh.astype(np.float32), "enc0": dh.sum(0), "tan": h.T @ dt, "gate": h.T @ dg, "att": (t * g).T @ ds, "out": z.T @ d, "out0": np.array([d.sum()])}

    @staticmethod
    def _attention(s: np.ndarray, starts: np.ndarray, of: np.ndarray) -> np.ndarray:
        e = np.exp(s - np.maximum.reduceat(s, starts)[of])
        return e / np.add.reduceat(e, starts)[of]

    def pooled(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each bag's passages the greatest attention score, the sum of weights relative to it, and the weighted sum."""
        w, starts = self.w, np.cumsum(sizes) - sizes
        h = np.tanh(((x - self.mean) / self.spread) @ w["enc"] + w["enc0"])
        s = (np.tanh(h @ w["tan"]) * _sigmoid(h @ w["gate"])) @ w["att"]
        top = np.maximum.reduceat(s, starts)
        e = np.exp(s - np.repeat(top, sizes))
        return top, np.add.reduceat(e, starts), np.add.reduceat(e[:, None] * h, starts, axis=0)

    def score(self, x: np.ndarray, sizes: np.ndarray, bags: np.ndarray | None = None) -> np.ndarray:
        """Scores of the texts; bags names the text of each run of passages, ascending from 0, if texts have several."""
        if not len(sizes):
            return np.empty(0)
        return self._scored(*self.pooled(x, sizes), np.arange(len(sizes)) if bags is None else bags)

    def _scored(self, top: np.ndarray, weight: np.ndarray, total: np.ndarray, bags: np.ndarray) -> np.ndarray:
        starts = np.flatnonzero(np.append(True, bags[1:] != bags[:-1]))
        share = np.exp(top - np.maximum.reduceat(top, starts)[bags])
        weight, total = np.add.reduceat(weight * share, starts), np.add.reduceat(total * share[:, None], starts, axis=0)
        return _sigmoid(total / weight[:, None] @ self.w["out"] + self.w["out0"])

    def score_column(self, text: Column) -> Column:
        """Probability that the text is of good quality; a null text counts as empty."""

        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            release()
            for batch in batches:
                runs = [(k, run) for k, t in enumerate(batch) for run in portions(t.encode())]
                texts = [run for _, run in runs]
                pooled = [self.pooled(*passages(texts[a:b])) for a, b in slices(texts)]
                yield pd.Series(self._scored(*map(np.concatenate, zip(*pooled, strict=True)), np.array([k for k, _ in runs])) if runs else np.empty(0))

        return F.pandas_udf(scored, "double")(F.coalesce(text.cast("string"), F.lit("")))


def fit_quality(documents: DataFrame, labels: DataFrame) -> AttentionModel | None:
    """A model from all passages of a sample of labelled documents outside the held-out fold; None without any.

    The sample has at most SAMPLE_ROWS documents and SAMPLE_BYTES of text; a longer text is not in it.
    """
    sample = labelled_sample(documents, labels, "quality", MODULUS, HELD_OUT, SAMPLE_ROWS, SAMPLE_BYTES)

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        for batch in batches:
            for label, text in zip(batch.label, batch.text, strict=True):
                x = np.concatenate([passages([run])[0] for run in portions(text.encode())])
                yield pd.DataFrame({"label": [label], "n": [len(x)], "x": [x.tobytes()]})

    found = sample.mapInPandas(bags, "label double, n long, x binary").toPandas()
    if found.empty:
        return None
    found = found.sort_values(["n", "x", "label"])  # the order in which rows come must not matter
    x = np.frombuffer(b"".join(found.x), np.float32).reshape(-1, FEATURES)
    return AttentionModel.fit(x, found.n.to_numpy(np.int64), found.label.to_numpy())


def _score(model: AttentionModel | None, text: Column) -> Column:
    return model.score_column(text) if model else F.lit(0.5)


def quality(docs: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs; the model is learned from documents and labels.

    An empty or null text is one empty passage; long texts are described PORTION bytes at a time. Without labelled
    rows every score is 0.5. Repeated rows give repeated results, a null doc_id is kept (held_out false), other
    columns are ignored; an empty table gives no rows.
    """
    model = fit_quality(documents, labels)
    out = texts_of(docs).select("doc_id", fold(F.col("doc_id"), MODULUS, HELD_OUT).alias("held_out"), _score(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def of_quality(docs: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, whose score is at least THRESHOLD.

    A null text is scored as an empty one and stays null; repeated rows stay or go together, null ids and columns
    of any name stay as they are; an empty table gives no rows, and without labelled rows all stay.
    """
    model = fit_quality(documents, labels)
    return kept_where(docs, lambda text: _score(model, text) >= THRESHOLD)
