"""Operator 3: quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words. Each passage becomes
counts of hashed words and of word shapes (case, first and last byte, length,
repetition), then a hidden vector h. Gated attention weighs the passages,
a ~ softmax(u . (tanh(V h) * sigmoid(G h))), and the weighted sum of the hidden
vectors is scored. Only documents have labels; what to attend to is learned.

The model is fitted on a bounded sample of whole texts (``labelled``): at most
SAMPLE_ROWS rows and SAMPLE_BYTES of text, every passage of each. Every passage
of every text is scored. A null or empty text is one empty passage. Repeated
rows get the same score; a null id counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import labelled, texts

PASSAGE_WORDS = 64
SHAPES, TERMS = 192, 64
HIDDEN, GATE = 24, 12
# Bytes of whole texts the fit takes at most: their counts fit into the driver.
SAMPLE_BYTES = 48 << 20
ROUNDS = 30
THRESHOLD = 0.5

SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
_KIND = np.full(256, 4, np.uint64)  # 0 lower, 1 upper, 2 digit, 3 beyond ASCII, else symbols by value
_KIND[32:127] = np.arange(32, 127)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 3


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature counts) of every passage; each text has one at least."""
    raw, at = texts.flat(column)
    w, n = texts.words(raw, at, texts.NOT_SPACE), len(column)
    size = np.bincount(w.doc, minlength=n)
    n_passages = np.maximum(1, -(-size // PASSAGE_WORDS))
    begin = np.cumsum(n_passages) - n_passages
    first = np.cumsum(size) - size
    mine = begin[w.doc] + (np.arange(len(w.doc)) - first[w.doc]) // PASSAGE_WORDS
    length = w.end - w.start
    again = np.zeros(len(w.doc), np.uint64)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    head, second = _KIND[raw[w.start]], _KIND[raw[np.minimum(w.start + 1, w.end - 1)]]
    tail, before = _KIND[raw[w.end - 1]], _KIND[raw[np.maximum(w.end - 2, w.start)]]
    shape = (((head * np.uint64(131) + second) * np.uint64(131) + tail) * np.uint64(131) + before) * np.uint64(2) + again
    shape = texts.mix(shape * np.uint64(8) + np.minimum(length, 7).astype(np.uint64) // np.uint64(2))
    width, total = SHAPES + TERMS, int(n_passages.sum())
    cells = np.concatenate([
        mine * width + (shape >> np.uint64(20)).astype(np.int64) % SHAPES,
        mine * width + SHAPES + (w.hash >> np.uint64(20)).astype(np.int64) % TERMS,
    ])
    counts = np.bincount(cells, minlength=total * width).reshape(total, width)
    return np.repeat(np.arange(n), n_passages), counts.astype(np.uint8)


def encoded(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts.astype(np.float32) / PASSAGE_WORDS)


class Attention(dict):
    """Weights by name: W b hidden, V c and G d gates, u attention, o z output."""

    @staticmethod
    def fresh(width: int, seed: int = 3) -> Attention:
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        return Attention(
            W=draw(width, HIDDEN) * 3, b=np.zeros(HIDDEN), V=draw(HIDDEN, GATE), c=np.zeros(GATE), G=draw(HIDDEN, GATE),
            d=np.zeros(GATE), u=draw(GATE, 1)[:, 0], o=draw(HIDDEN, 1)[:, 0], z=np.zeros(1),
        )

    def forward(self, x: np.ndarray, bag: np.ndarray, n: int) -> dict[str, np.ndarray]:
        h = np.tanh(x @ self["W"] + self["b"])
        t, g = np.tanh(h @ self["V"] + self["c"]), 1 / (1 + np.exp(-(h @ self["G"] + self["d"])))
        e = (t * g) @ self["u"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, bag, e)
        e = np.exp(e - top[bag])
        a = e / np.bincount(bag, e, n)[bag]
        r = np.zeros((n, h.shape[1]))
        np.add.at(r, bag, a[:, None] * h)
        return {"h": h, "t": t, "g": g, "a": a, "r": r, "p": 1 / (1 + np.exp(-np.clip(r @ self["o"] + self["z"], -60, 60)))}

    def gradients(self, x: np.ndarray, bag: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        s = self.forward(x, bag, len(label))
        error = (s["p"] - label) / len(label)
        dr = error[:, None] * self["o"]
        da = (dr[bag] * s["h"]).sum(1)
        de = s["a"] * (da - np.bincount(bag, s["a"] * da, len(label))[bag])
        dt, dg = de[:, None] * self["u"] * s["g"] * (1 - s["t"] ** 2), de[:, None] * self["u"] * s["t"] * s["g"] * (1 - s["g"])
        dh = (s["a"][:, None] * dr[bag] + dt @ self["V"].T + dg @ self["G"].T) * (1 - s["h"] ** 2)
        return {
            "W": x.T @ dh, "b": dh.sum(0), "V": s["h"].T @ dt, "c": dt.sum(0), "G": s["h"].T @ dg, "d": dg.sum(0),
            "u": (s["t"] * s["g"]).T @ de, "o": s["r"].T @ error, "z": error.sum(keepdims=True),
        }


def fit(bag: np.ndarray, counts: np.ndarray, label: np.ndarray, seed: int = 3) -> Attention:
    """Adam over mini-batches of documents in a fixed order."""
    model, rng, n = Attention.fresh(counts.shape[1], seed), np.random.default_rng(seed), len(label)
    if not n:
        model["o"][:] = 0  # nothing to learn from: every score is 0.5
    begin = np.searchsorted(bag, np.arange(n + 1))
    mean, square = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    step = 0
    for _ in range(ROUNDS):
        order = rng.permutation(n)
        for docs in (order[k : k + 64] for k in range(0, n, 64)):
            rows = np.concatenate([np.arange(begin[d], begin[d + 1]) for d in docs])
            bags = np.repeat(np.arange(len(docs)), begin[docs + 1] - begin[docs])
            step += 1
            for k, g in model.gradients(encoded(counts[rows]), bags, label[docs]).items():
                g = g + 1e-4 * model[k]
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                model[k] -= 0.01 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS) -> Attention:
    """Fit on at most ``rows`` labelled rows; their passage counts come to the driver."""
    width = SHAPES + TERMS
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("counts", pa.binary())])

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bag, counts = passages(part.column("text"))
        begin = np.searchsorted(bag, np.arange(part.num_rows + 1))
        rows = [counts[a:b].tobytes() for a, b in zip(begin, begin[1:])]
        yield texts.record(schema, part.column("doc_id"), part.column("label"), rows)

    found = labelled.sample(docs, labels, "quality", rows, SAMPLE_BYTES)
    got = texts.map_texts(found, work, "doc_id long, label int, counts binary", ("label",)).toArrow().sort_by("doc_id")
    bags = [np.frombuffer(x, np.uint8).reshape(-1, width) for x in got.column("counts").to_pylist()]
    counts = np.concatenate(bags) if bags else np.zeros((0, width), np.uint8)
    return fit(np.repeat(np.arange(len(bags)), [len(x) for x in bags]), counts, got.column("label").to_numpy())


def score(docs: DataFrame, model: Attention) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bag, counts = passages(part.column("text"))
        yield texts.record(SCHEMA, part.column("doc_id"), model.forward(encoded(counts), bag, part.num_rows)["p"])

    scored = texts.map_texts(docs, work, "doc_id long, score double")
    return scored.select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS) -> DataFrame:
    """The documents the classifier accepts, with all their columns; their texts go to Python once."""
    model = train(docs, labels, rows)

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches):
            bag, counts = passages(part.column(texts.TEXT).fill_null(""))
            good = model.forward(encoded(counts), bag, part.num_rows)["p"] >= THRESHOLD
            yield part.filter(pa.array(good))

    return docs.mapInArrow(accepted, docs.schema)
