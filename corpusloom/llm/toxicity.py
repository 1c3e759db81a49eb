"""Operator 4: toxicity by a factorization machine over hashed terms.

Terms are a text's words and their stems (first bytes), hashed into BUCKETS.
The score is a bias, a weight for every term present and, for every two of
them, the product of their factor vectors, so that a pair can count for more or
less than its parts: sum over f of ((sum v)^2 - sum v^2) / 2.

Terms are learned that tell the labels apart alone, or together with another
term that neither does alone (``paired``): a pair that is toxic only together
keeps both its terms. The others would only learn the training texts by heart.
It is fitted on a bounded sample (``labelled``) and sent to every task as a
table of BUCKETS rows. A null or empty text has no terms and gets the bias.
Repeated rows get the same score; a null id counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import labelled, texts

BUCKETS = 1 << 17
FACTORS = 4
STEM_BYTES = (4, 5, 6, 7)
THRESHOLD = 0.7
ROUNDS = 20
MIN_TEXTS, MIN_CHI_SQUARE = 4, 14.0
# Pairs of terms: each term's and the pair's least share of the sampled texts, the chi-square of their interaction
# (the best of millions of pairs by chance stays below), and the terms whose pairs are counted at a time.
MIN_PAIR_SHARE, MIN_PAIR_CHI_SQUARE, PAIR_BLOCK = 0.01, 49.0, 1024

SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def terms(texts_column: pa.Array, useful: np.ndarray | None = None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of the distinct terms of each text, in order; of the ``useful`` buckets if given."""
    raw, at = texts.flat(texts_column)
    w = texts.words(raw, at, texts.WORD_BYTES)
    kinds = [w.hash]
    for n in STEM_BYTES:
        kinds.append(texts.stems(raw, w, n))
    keys = []
    for hashed in kinds:
        bucket = (hashed >> np.uint64(40)).astype(np.int64) % buckets
        mine = slice(None) if useful is None else np.flatnonzero(useful[bucket])
        keys.append(w.doc[mine] * buckets + bucket[mine])
    key = np.unique(np.concatenate(keys))
    return key // buckets, key % buckets


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        v = self.factors[bucket]
        pairs = np.zeros(n)
        for f in range(v.shape[1]):
            pairs += np.bincount(doc, v[:, f], n) ** 2 - np.bincount(doc, v[:, f] ** 2, n)
        return self.bias + np.bincount(doc, self.weights[bucket], n) + pairs / 2


def telling(held: np.ndarray, toxic: np.ndarray, n: int, n_toxic: float) -> np.ndarray:
    """Buckets in MIN_TEXTS texts at least whose chi-square against the label reaches MIN_CHI_SQUARE."""
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = n * (toxic * n - held * n_toxic) ** 2 / (held * (n - held) * n_toxic * (n - n_toxic))
    return (held >= MIN_TEXTS) & (np.nan_to_num(chi, posinf=0.0) >= MIN_CHI_SQUARE)


def paired(doc: np.ndarray, bucket: np.ndarray, label: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Buckets, not ``alone``, that belong to a pair whose interaction tells the labels apart.

    Interaction: the sum over texts of both terms' and the label's deviations
    from their means. Terms held by the same texts count as one.
    """
    n, found = len(label), np.zeros(len(alone), bool)
    least = max(MIN_TEXTS, int(np.ceil(MIN_PAIR_SHARE * n)))
    held = np.bincount(bucket, minlength=len(alone))
    mine = (held >= least) & (held <= n - least) & ~alone
    doc, bucket = doc[mine[bucket]], bucket[mine[bucket]]
    if not len(doc) or label.min() == label.max():
        return found
    sums = np.bincount(bucket, texts.random_values(n, 17)[doc] >> np.uint64(12), len(alone))
    terms_at = np.flatnonzero(mine)
    _, first, same = np.unique(np.stack([sums[mine], held[mine]], axis=1), axis=0, return_index=True, return_inverse=True)
    column = np.full(len(alone), -1)
    column[terms_at[first]] = np.arange(len(first))
    at = column[bucket]
    doc, at = doc[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    doc, at = doc[order], at[order]
    p = (held[terms_at[first]] / n).astype(np.float32)
    y = (label - label.mean()).astype(np.float32)
    blocks = range(0, len(first), PAIR_BLOCK)

    def present(a: int) -> np.ndarray:
        x, y = np.searchsorted(at, [a, a + PAIR_BLOCK])
        table = np.zeros((n, min(PAIR_BLOCK, len(first) - a)), np.float32)
        table[doc[x:y], at[x:y] - a] = 1
        return table

    good = np.zeros(len(first), bool)
    for a in blocks:
        one, pa_ = present(a), p[a : a + PAIR_BLOCK, None]
        weighed = (one - pa_.T) * y[:, None]
        for b in blocks[a // PAIR_BLOCK :]:
            other = one if a == b else present(b)
            pb = p[None, b : b + PAIR_BLOCK]
            both = one.T @ other / n
            # deviations of the label sum to zero, so a mean comes in once per column
            effect = weighed.T @ other - weighed.sum(0)[:, None] * pb
            # what the effect would vary by if the label knew nothing of the two, however alike they are
            square = pa_**2 * pb**2 + pa_**2 * (1 - 2 * pb) * pb + pb**2 * (1 - 2 * pa_) * pa_ + (1 - 2 * pa_) * (1 - 2 * pb) * both
            spread = np.maximum(square - (both - pa_ * pb) ** 2, 0)
            strong = (effect**2 >= MIN_PAIR_CHI_SQUARE * n * y.var() * spread) & (both * n >= least - 0.5)
            if a == b:
                np.fill_diagonal(strong, False)
            good[a : a + PAIR_BLOCK] |= strong.any(1)
            good[b : b + PAIR_BLOCK] |= strong.any(0)
    found[terms_at] = good[same.reshape(-1)]
    return found


def fit(doc: np.ndarray, bucket: np.ndarray, label: np.ndarray, buckets: int = BUCKETS, seed: int = 5) -> Machine:
    """Stochastic gradient with per-weight step sizes on the log loss, over documents in a fixed order."""
    rng, n = np.random.default_rng(seed), len(label)
    # terms too rare or too evenly spread to tell the labels apart would only learn the training texts by heart
    common = telling(np.bincount(bucket, minlength=buckets), np.bincount(bucket, label[doc], buckets), n, float(label.sum()))
    common |= paired(doc, bucket, label, common)
    doc, bucket = doc[common[bucket]], bucket[common[bucket]]
    rate = float(np.clip(label.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    bias = np.log(rate / (1 - rate))
    w, v = np.zeros(buckets, np.float32), rng.normal(0, 0.01, (buckets, FACTORS)).astype(np.float32)
    w2, v2, b2 = np.ones(buckets, np.float32), np.ones((buckets, FACTORS), np.float32), 1.0
    begin = np.searchsorted(doc, np.arange(n + 1))
    for step in range(ROUNDS):
        for d in rng.permutation(n).tolist():
            x = bucket[begin[d] : begin[d + 1]]
            vx = v[x]
            total = vx.sum(0)
            margin = bias + float(w[x].sum()) + float((total**2 - (vx**2).sum(0)).sum()) / 2
            error = 1 / (1 + np.exp(-max(-60.0, min(60.0, margin)))) - label[d]
            if abs(error) < 1e-3:
                continue
            gw, gv = error + 1e-4 * w[x], error * (total - vx) + 1e-3 * vx
            w2[x] += gw * gw
            v2[x] += gv * gv
            b2 += error * error
            w[x] -= 0.3 * gw / np.sqrt(w2[x])
            v[x] -= 0.1 * gv / np.sqrt(v2[x])
            bias -= 0.3 * error / np.sqrt(b2)
    v[~common] = 0
    return Machine(float(bias), w, v)


def train(docs: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS) -> Machine:
    """Fit on at most ``rows`` labelled rows; their distinct buckets come to the driver."""
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("buckets", pa.list_(pa.int32()))])

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc, bucket = terms(part.column("text"))
        at = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(bucket.astype(np.int32)))
        yield texts.record(schema, part.column("doc_id"), part.column("label"), lists)

    found = labelled.sample(docs, labels, "toxic", rows)
    got = texts.map_texts(found, work, "doc_id long, label int, buckets array<int>", ("label",)).toArrow().sort_by("doc_id")
    got = got.combine_chunks()
    lists = got.column("buckets").combine_chunks()
    size = np.diff(lists.offsets.to_numpy()) if got.num_rows else np.zeros(0, np.int64)
    return fit(
        np.repeat(np.arange(got.num_rows), size), lists.flatten().to_numpy().astype(np.int64), got.column("label").to_numpy()
    )


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    useful = (machine.weights != 0) | np.any(machine.factors != 0, axis=1)

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc, bucket = terms(part.column("text"), useful)
        margin = machine.margins(doc, bucket, part.num_rows)
        yield texts.record(SCHEMA, part.column("doc_id"), 1 / (1 + np.exp(-np.clip(margin, -60, 60))))

    scored = texts.map_texts(docs, work, "doc_id long, score double")
    return scored.select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
