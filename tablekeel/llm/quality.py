"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of forty words. Each passage is encoded by how its
characters and words look (n-grams of character classes, word lengths, repetition). A
hidden layer, gated attention over a document's passages, and a linear score of the
passages' weighted mean are learned together from labels of whole documents, so that one
bad passage in a long document can decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeel.llm.common import WordHasher, mixed, pick, pieces, position, small, text_bytes, training_row, unused

PASSAGE_WORDS = 40
#: Bytes of text whose passages are held at a time.
PART_BYTES = 1 << 20
_CLASSES = 6
FEATURES = _CLASSES**3 + 6


def _classes() -> np.ndarray:
    """Character classes of bytes: 0 lower or beyond ASCII, 1 upper, 2 digit, 3 space, 4 sentence marks, 5 other marks."""
    table = np.full(256, 5, dtype=np.int64)
    table[128:] = 0
    table[97:123] = 0
    table[65:91] = 1
    table[48:58] = 2
    table[[9, 10, 11, 12, 13, 32]] = 3
    table[[ord(c) for c in ".,;:'\"()-"]] = 4
    return table


_CLASS = _classes()


def passages(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and for each text the number of passages before it; each text has one at least."""
    starts, ends = hasher.words(data, offsets)
    first = np.searchsorted(starts, offsets)
    words = np.diff(first)
    count = np.maximum(1, -(-words // PASSAGE_WORDS))
    before = np.concatenate([[0], np.cumsum(count)])
    total = before[-1]
    of_word = np.repeat(before[:-1], words) + (np.arange(len(starts)) - np.repeat(first[:-1], words)) // PASSAGE_WORDS
    of_byte = np.repeat(before[:-1], np.diff(offsets))
    if len(starts):  # a byte belongs to the passage of the last word that has begun in its text
        begun = np.zeros(len(data), dtype=np.int64)
        begun[starts] = of_word - np.repeat(before[:-1], words)
        opens = offsets[:-1][np.diff(offsets) > 0]
        shift = np.zeros(len(data), dtype=np.int64)
        # Within a text passage numbers only grow, so a running maximum of number plus the text's base is enough.
        base = np.zeros(len(data), dtype=np.int64)
        base[opens] = before[:-1][np.diff(offsets) > 0]
        shift = np.maximum.accumulate(base)
        of_byte = np.maximum.accumulate(shift + begun)
    x = np.zeros((total, FEATURES), dtype=np.float32)
    c = _CLASS[data]
    if len(c) > 2:
        key = of_byte[:-2] * _CLASSES**3 + (c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:]
        key = key[of_byte[:-2] == of_byte[2:]]
        # bincount over a bounded number of bytes (see pieces) and so of passages
        x[:, : _CLASSES**3] = np.bincount(key, minlength=total * _CLASSES**3).reshape(total, -1)
    x[:, : _CLASSES**3] /= np.maximum(1, x[:, : _CLASSES**3].sum(axis=1, keepdims=True))
    n = np.bincount(of_word, minlength=total).astype(np.float32)
    some = np.maximum(n, 1)
    length = ends - starts
    hashes = hasher.hashes(data, starts, ends)
    order = np.lexsort((hashes, of_word))
    same = np.zeros(len(starts), dtype=bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (of_word[order][1:] == of_word[order][:-1])
    next_to = np.zeros(len(starts), dtype=bool)
    next_to[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    x[:, -6] = np.bincount(of_word, weights=length, minlength=total) / some / 10
    x[:, -5] = np.bincount(of_word[order], weights=same, minlength=total) / some
    x[:, -4] = np.bincount(of_word, weights=next_to, minlength=total) / some
    x[:, -3] = np.log1p(n)
    x[:, -2] = np.bincount(of_word, weights=length > 20, minlength=total) / some
    x[:, -1] = n == 0
    return x, before


def long_parts(text: np.ndarray, hasher: WordHasher) -> Iterator[np.ndarray]:
    """A text cut where passages begin, in parts of about PART_BYTES, so that its passages stay the same."""
    at, size = 0, PART_BYTES
    while len(text) - at > size:
        part = text[at : at + size]
        starts, _ = hasher.words(part, np.array([0, len(part)]))
        whole = (len(starts) - 1) // PASSAGE_WORDS * PASSAGE_WORDS  # the last word may go on
        if whole <= 0:
            size *= 2
            continue
        yield part[: starts[whole]]
        at, size = at + int(starts[whole]), PART_BYTES
    yield text[at:]


def chosen(parts: Iterator[np.ndarray], most: int, seed: int) -> np.ndarray:
    """Features of a text's passages, or of so many of them, those whose numbers have the least hashes, wherever they stand."""
    kept, order, at = np.zeros((0, FEATURES), dtype=np.float16), np.zeros(0, dtype=np.uint64), 0
    for x in parts:
        number = np.arange(at, at + len(x), dtype=np.uint64)
        kept = np.concatenate([kept, x.astype(np.float16)])
        order = np.concatenate([order, mixed(number + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))])
        at += len(x)
        if len(kept) > most:
            least = np.sort(np.argpartition(order, most - 1)[:most])
            kept, order = kept[least], order[least]
    return kept


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class QualityModel:
    """Weights by name, and the scaling of features; None for weights means that one label or none was seen."""

    weights: dict[str, np.ndarray] | None
    mean: np.ndarray
    scale: np.ndarray
    constant: float = 0.5

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) * self.scale) @ self.weights["E"] + self.weights["e"])

    def attend(self, h: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gates, attention of each passage within its document, and each document's weighted passage."""
        t, g = np.tanh(h @ self.weights["V"]), _sigmoid(h @ self.weights["U"])
        raw = (t * g) @ self.weights["w"]
        raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, before[:-1]), np.diff(before)))
        a = raw / np.repeat(np.add.reduceat(raw, before[:-1]), np.diff(before))
        return t, g, a, np.add.reduceat(a[:, None] * h, before[:-1], axis=0)

    def score_long(self, text: np.ndarray, hasher: WordHasher) -> float:
        """The score of one text of any length, from parts of it, with attention summed up as they come."""
        if self.weights is None:
            return self.constant
        top, total, mean = -np.inf, 0.0, np.zeros(len(self.weights["c"]))
        for part in long_parts(text, hasher):
            h = self.hidden(passages(part, np.array([0, len(part)]), hasher)[0])
            raw = (np.tanh(h @ self.weights["V"]) * _sigmoid(h @ self.weights["U"])) @ self.weights["w"]
            high = max(top, float(raw.max()))
            share = np.exp(raw - high)
            fade = np.exp(top - high)
            total, mean, top = total * fade + share.sum(), mean * fade + share @ h, high
        return float(_sigmoid((mean / total) @ self.weights["c"] + self.weights["b"][0]))

    def score(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(before) - 1, self.constant)
        z = self.attend(self.hidden(x), before)[-1]
        return _sigmoid((z @ self.weights["c"] + self.weights["b"]).astype(np.float64))


def fit(x: np.ndarray, before: np.ndarray, y: np.ndarray, *, hidden: int, gate: int, epochs: int, seed: int) -> QualityModel:
    """Log loss by Adam over batches of documents, with the gradients written out."""
    mean = x.mean(axis=0)
    # Some columns at a time, and later the rows of a batch: a scaled copy of x would take its memory once more.
    scale = 1 / np.maximum(np.concatenate([x[:, k : k + 32].std(axis=0) for k in range(0, x.shape[1], 32)]), 1e-3)
    if len(set(y.tolist())) < 2:
        return QualityModel(None, mean, scale, float(y[0]) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {
        "E": draw(x.shape[1], hidden),
        "e": np.zeros(hidden, np.float32),
        "V": draw(hidden, gate),
        "U": draw(hidden, gate),
        "w": draw(gate),
        "c": draw(hidden),
        "b": np.zeros(1, np.float32),
    }
    model = QualityModel(p, mean, scale)
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 256):
            bags = order[at : at + 256]
            size = before[bags + 1] - before[bags]
            edge = np.concatenate([[0], np.cumsum(size)])
            rows = np.repeat(before[bags] - edge[:-1], size) + np.arange(edge[-1])
            xs = (x[rows] - mean) * scale
            h = np.tanh(xs @ p["E"] + p["e"])
            t, g, a, z = model.attend(h, edge)
            error = ((_sigmoid(z @ p["c"] + p["b"]) - y[bags]) / len(bags)).astype(np.float32)
            dz = np.repeat(error[:, None] * p["c"], size, axis=0)
            da = (dz * h).sum(axis=1)
            draw_ = a * (da - np.repeat(np.add.reduceat(a * da, edge[:-1]), size))
            dt = draw_[:, None] * p["w"] * g * (1 - t * t)
            dg = draw_[:, None] * p["w"] * t * g * (1 - g)
            dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
            grad = {
                "E": xs.T @ dh,
                "e": dh.sum(axis=0),
                "V": h.T @ dt,
                "U": h.T @ dg,
                "w": (t * g).T @ draw_,
                "c": z.T @ error,
                "b": error.sum(keepdims=True),
            }
            step += 1
            rate = 0.01 * (1 - epoch / epochs)
            for k in p:
                d = grad[k] + 1e-5 * p[k]
                first[k] += 0.1 * (d - first[k])
                second[k] += 0.001 * (d * d - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    only: Column | None = None,
    *,
    sample_rows: int = 4_000,
    passages_each: int = 64,
    hidden: int = 24,
    gate: int = 12,
    epochs: int = 25,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
) -> QualityModel:
    """Learn from about sample_rows labelled documents at most, chosen by a hash of doc_id.

    only: a condition on doc_id. The features of the sample, and nothing else, come to the
    driver: sample_rows * passages_each * FEATURES numbers at most. A text of more than
    passages_each passages teaches by so many of them, chosen by a hash over the whole text.
    A doc_id with several labels counts as 1 if any is 1; null ids, labels and texts teach
    nothing. Without labels of both kinds the score is constant.
    """
    marks = pick(labels, doc_id=doc_id, quality=quality).where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if only is not None:
        marks = marks.where(only)
    marks = marks.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    scale = 1 << 30
    n = marks.count()
    marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < min(scale, scale * sample_rows // max(n, 1)))
    rows = pick(docs, doc_id=doc_id, text=text).where(F.col("text").isNotNull())
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < min(scale, scale * sample_rows // max(n, 1)))
    rows = rows.join(small(marks, min(n, sample_rows)), "doc_id").select("doc_id", "text", "quality")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for part in pieces(batch, "text", PART_BYTES):
                data, offsets = text_bytes(part.column("text"))
                if len(data) > PART_BYTES:  # then it is a single text
                    each = [(passages(p, np.array([0, len(p)]), hasher)[0] for p in long_parts(data, hasher))]
                else:
                    x, before = passages(data, offsets, hasher)
                    each = [iter([x[a:b]]) for a, b in zip(before[:-1], before[1:], strict=True)]
                bags = [chosen(xs, passages_each, seed).tobytes() for xs in each]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("quality").cast(pa.int32()), pa.array(bags, pa.binary())],
                    names=["doc_id", "quality", "bag"],
                )

    found = rows.mapInArrow(encode, "doc_id long, quality int, bag binary").toArrow()
    if not len(found):
        return QualityModel(None, np.zeros(FEATURES), np.ones(FEATURES))
    order = pc.sort_indices(found, sort_keys=[("doc_id", "ascending"), ("bag", "ascending")])  # the table itself stays as it came
    size = pc.binary_length(found.column("bag")).to_numpy()[order] // (2 * FEATURES)
    before = np.concatenate([[0], np.cumsum(size)])
    y = (found.column("quality").to_numpy()[order] == 1).astype(np.float32)
    x = np.empty((before[-1], FEATURES), dtype=np.float32)
    for at, n, row in zip(before[:-1], size, order.to_pylist(), strict=True):
        bag = found.column("bag")[row]
        x[at : at + n] = np.frombuffer(bag.as_buffer(), dtype=np.float16).reshape(-1, FEATURES)
    del found, bag
    return fit(x, before, y, hidden=hidden, gate=gate, epochs=epochs, seed=seed)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """docs with score added (under a name with "_" appended if docs has such a column).

    A null text counts as empty; an empty text is one passage without words, and has a
    score like any other. No shuffle; a task holds one Arrow batch, and the features of
    PART_BYTES of text, however long a text is.
    """
    names = list(docs.columns)
    place = position(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hasher = shared.value, WordHasher()
        for batch in batches:
            for part in pieces(batch, f"_{place}", PART_BYTES):
                data, offsets = text_bytes(part.column(f"_{place}"))
                if len(data) > PART_BYTES:  # then it is a single text
                    scores = np.array([own.score_long(data, hasher)])
                else:
                    scores = own.score(*passages(data, offsets, hasher))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f"_{i}") for i in range(len(names))], pa.array(scores, pa.float64())],
                    names=[*[f"_{i}" for i in range(len(names))], "score"],
                )

    kinds = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    numbered = docs.toDF(*[f"_{i}" for i in range(len(names))])
    return numbered.mapInArrow(score, f"{kinds}, score double").toDF(*names, unused(docs, "score"))


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels of rows that are not held out."""
    model = learn_quality(docs, labels, training_row(F.col("doc_id")))
    rows = score_quality(pick(docs, doc_id="doc_id", text="text"), model)
    return rows.select(
        "doc_id",
        (~training_row(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
