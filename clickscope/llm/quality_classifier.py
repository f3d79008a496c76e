"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (64 words each).  Every passage is encoded
(shares of its words in ``WORDS`` hashed places, whose embeddings are rows of the hidden layer, and
shares of letter, case, symbol and repetition classes), the hidden layer and
gated attention weights are learned from the document labels alone, and the
attention-weighted passage representation is scored.

The model is fitted on at most ``TRAIN_DOCS`` labelled documents (smallest
hashes of their ids, only rows whose crc32(doc_id) mod 4 is not 2), fewer if they
hold more than ``TRAIN_PASSAGES`` passages together; both bounds are
parameters, and no document is cut.  Scoring reads every passage of every document.

Cases: a null or empty text is one empty passage and gets a score like any
other; labels without a quality are not learned from; several labels of one id
count by their mean, several texts of one id by the one with the smallest digest; if nothing is labelled every score is the prior 0.5;
repeated rows each have a row; an empty table gives an empty table; of
``docs`` only doc_id and text are read.
"""

from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc32_of_id, pack, prepared, texts, unpack, written

PASSAGE = 64
TRAIN_DOCS = 4000
TRAIN_PASSAGES = 100_000
WORDS = 128
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE = 30, 64, 0.01
THRESHOLD = 0.7

#: Byte -> class: a-z one each, then capitals, digits, spaces, line ends, each ASCII mark, high bytes.
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(26)
_CLASS[65:91] = 26
_CLASS[48:58] = 27
_CLASS[[9, 11, 12, 13, 32]] = 28
_CLASS[10] = 29
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_MARKS] = 30 + np.arange(len(_MARKS))
_HIGH = 30 + len(_MARKS)
_CLASS[128:] = _HIGH
_CLASSES = _HIGH + 1
FEATURES = _CLASSES + 5 + WORDS


def encode(text: bytes | None) -> np.ndarray:
    """(passages, FEATURES) of one whole text; at least one passage."""
    words = text.split() if text else []
    n = max(1, -(-len(words) // PASSAGE))
    out = np.zeros((n, FEATURES), np.float32)
    for k in range(n):
        own = words[k * PASSAGE:(k + 1) * PASSAGE]
        if not own:
            out[k, -1] = 1
            continue
        raw = b" ".join(own)
        out[k, :_CLASSES] = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=_CLASSES) / len(raw)
        same = sum(map(bytes.__eq__, own[1:], own))
        out[k, _CLASSES + WORDS:] = (len(set(own)) / len(own), same / len(own), len(raw) / len(own) / 10,
                                     len(own) / PASSAGE, 0)
        place = np.fromiter(map(crc32, own), np.uint32, len(own)) % WORDS
        out[k, _CLASSES:_CLASSES + WORDS] = np.bincount(place, minlength=WORDS) / len(own)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Gated-attention model; ``bags`` are rows of passages with the start of each document."""

    def __init__(self, features: int = FEATURES, seed: int = 7):
        g = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(features, np.float32), np.ones(features, np.float32)
        init = lambda a, b: (g.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.p = {"W": init(features, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE),
                  "w": init(GATE, 1), "c": init(HIDDEN, 1), "c0": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, start: np.ndarray):
        p = self.p
        size = np.diff(np.append(start, len(x)))
        bag = np.repeat(np.arange(len(start)), size)
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        s = ((v * u) @ p["w"])[:, 0]
        e = np.exp(s - np.maximum.reduceat(s, start)[bag])
        a = e / np.add.reduceat(e, start)[bag]
        z = np.add.reduceat(a[:, None] * h, start)
        return bag, h, v, u, a, z, _sigmoid((z @ p["c"])[:, 0] + p["c0"][0])

    def gradients(self, x, start, y):
        p = self.p
        bag, h, v, u, a, z, out = self.forward(x, start)
        dl = ((out - y) / len(y))[:, None].astype(np.float32)
        dz = (dl @ p["c"].T)[bag]
        da = (dz * h).sum(axis=1)
        ds = (a * (da - np.add.reduceat(a * da, start)[bag]))[:, None]
        dv, du = ds @ p["w"].T * u * (1 - v * v), ds @ p["w"].T * v * u * (1 - u)
        dh = a[:, None] * dz + dv @ p["V"].T + du @ p["U"].T
        dx = dh * (1 - h * h)
        return {"W": x.T @ dx, "b": dx.sum(axis=0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ ds,
                "c": z.T @ dl, "c0": dl.sum(axis=0)}

    def fit(self, bags: list[np.ndarray], y: np.ndarray) -> "Model":
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(axis=0), np.maximum(every.std(axis=0), 1e-3)
        bags = [self.scaled(b) for b in bags]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        g, t = np.random.default_rng(11), 0
        for _ in range(EPOCHS):
            order = g.permutation(len(bags))
            for k in range(0, len(order), BATCH):
                own = order[k:k + BATCH]
                sizes = [len(bags[i]) for i in own]
                grads = self.gradients(np.concatenate([bags[i] for i in own]), np.cumsum([0, *sizes[:-1]]), y[own])
                t += 1
                for name, d in grads.items():  # Adam with a little weight decay
                    d = d + 1e-4 * self.p[name]
                    m[name] = 0.9 * m[name] + 0.1 * d
                    s[name] = 0.999 * s[name] + 0.001 * d * d
                    self.p[name] = (self.p[name] - RATE * (m[name] / (1 - 0.9 ** t))
                                    / (np.sqrt(s[name] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        return self

    def scaled(self, x):
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        sizes = [len(b) for b in bags]
        return self.forward(self.scaled(np.concatenate(bags)), np.cumsum([0, *sizes[:-1]]))[-1]


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model, or None when no label can be learned from."""
    spark = prepared(docs.sparkSession)
    sample = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (crc32_of_id() % 4 != 2))
              .groupBy("doc_id").agg(F.avg("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS).collect())
    if not sample:
        return None
    of = spark.createDataFrame([(r["doc_id"], float(r["quality"])) for r in sample], "doc_id long, quality double")

    def run(batches):
        for pdf in batches:
            bags = [encode(t) for t in pdf["text"].tolist()]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "own": [sha256(t or b"").digest() for t in pdf["text"].tolist()],
                                "n": [len(b) for b in bags], "bag": [pack(b) for b in bags]})

    # TRAIN_DOCS rows at most on the broadcast side
    every = written(texts(docs).join(F.broadcast(of), "doc_id").mapInPandas(run, "doc_id long, quality double, own binary, n long, bag binary"),
                    "quality-bags")
    one = every.groupBy("doc_id").agg(F.min("own").alias("own"))
    some = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # over TRAIN_DOCS rows at most
    fit = (every.dropDuplicates(["doc_id", "own"]).join(one, ["doc_id", "own"])
           .withColumn("sofar", F.sum("n").over(some)))
    got = fit.where(F.col("sofar") <= TRAIN_PASSAGES).select("doc_id", "quality", "bag").orderBy("doc_id").collect()
    if not got:
        return None
    bags = [unpack(r["bag"], np.float32).reshape(-1, FEATURES) for r in got]
    return Model().fit(bags, np.array([r["quality"] for r in got], np.float32))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            m = sent.value
            bags = [encode(t) for t in pdf["text"].tolist()]
            score = np.full(len(pdf), 0.5) if m is None else m.scores(bags).astype(np.float64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"], "score": score,
                                "predicted": (score >= THRESHOLD).astype(np.int32)})

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), (crc32_of_id() % 4 == 2).alias("held_out"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")
