"""Whole texts as Arrow slices, and their words as numpy arrays.

Every function here sees each text whole; slices only bound how many texts are
in memory at a time. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text worked on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
# Bytes hashed at a time, so that temporary arrays stay small for any text.
CHUNK_BYTES = 1 << 21

ID, TEXT = "doc_id", "text"


def map_texts(docs: DataFrame, work: Callable, schema: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """``work(slice)`` over slices of (doc_id, *extra, text); it yields record batches."""
    names = (ID, *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield from work(part)

    rows = docs.select(*names, F.coalesce(F.col(TEXT).cast("string"), F.lit("")).alias(TEXT))
    return rows.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], text: str = TEXT) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about SLICE_BYTES of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the n + 1 places where they begin."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


@dataclass
class Words:
    """Words in order: text number, byte range in the flat bytes, hash."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_values(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def byte_class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


# Word bytes: all but ASCII white space; letters, digits and everything beyond ASCII.
NOT_SPACE = ~byte_class(b" \t\n\x0b\x0c\r")
WORD_BYTES = byte_class(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)))

_BYTE_VALUES = random_values(256, 11)
_BYTE_VALUES[65:91] = _BYTE_VALUES[97:123]  # A-Z as a-z
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)


def words(raw: np.ndarray, at: np.ndarray, inside: np.ndarray = NOT_SPACE) -> Words:
    """All words of all texts; ``inside`` marks the bytes words are made of, letters A-Z count as a-z."""
    bounds = np.unique(at)
    parts, a = [], 0
    while a < len(raw):
        b = min(len(raw), a + CHUNK_BYTES)
        if b < len(raw):  # go on to the end of the word
            while b < len(raw):
                stop = np.flatnonzero(~inside[raw[b : b + 4096]])
                if len(stop):
                    b += int(stop[0])
                    break
                b = min(len(raw), b + 4096)
        parts.append(_words(raw[a:b], bounds[(bounds > a) & (bounds < b)] - a, inside, a))
        a = b
    if not parts:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(np.uint64))
    start, end, hashed = (np.concatenate(x) for x in zip(*parts))
    return Words(np.searchsorted(at[1:], start, side="right"), start, end, hashed)


def _words(raw: np.ndarray, bounds: np.ndarray, inside: np.ndarray, shift: int):
    is_in = inside[raw]
    change = np.empty(len(raw) + 1, bool)
    change[0], change[-1] = is_in[0], is_in[-1]
    np.not_equal(is_in[1:], is_in[:-1], out=change[1:-1])
    edges = np.flatnonzero(change)
    start, end = edges[::2], edges[1::2]
    if len(bounds):  # texts that touch: a word ends with its text
        cut = bounds[is_in[bounds] & is_in[bounds - 1]]
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    powers = np.multiply.accumulate(np.full(int(size.max()), _STEP, np.uint64))
    values = _BYTE_VALUES[raw[is_in]] * powers[place]
    hashed = mix(np.add.reduceat(values, first) + size.astype(np.uint64))
    return start + shift, end + shift, hashed


def stems(raw: np.ndarray, w: Words, n: int) -> np.ndarray:
    """Hash of the first n bytes of each word; a shorter word's own bytes."""
    total = np.full(len(w.start), n, np.uint64)
    powers, size = np.multiply.accumulate(np.full(n, _STEP, np.uint64)), w.end - w.start
    for k in range(n):
        here = np.flatnonzero(size > k)
        total[here] += _BYTE_VALUES[raw[w.start[here] + k]] * powers[k]
    return mix(total)


def runs(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every run of n successive words of a text."""
    if len(w.doc) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(len(w.hash) - n + 1, np.uint64)
    for k in range(n):
        total = total * _STEP + w.hash[k : len(w.hash) - n + 1 + k]
    same = w.doc[: len(total)] == w.doc[n - 1 :]
    return w.doc[: len(total)][same], mix(total[same])


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, schema)], schema=schema)
