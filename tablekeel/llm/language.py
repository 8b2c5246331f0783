"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1. For each bit, a binary classifier over byte
n-grams (log-likelihood ratios of the languages on either side) gives a margin. Decoding
takes the codeword with the least loss, where each bit weighs as much as its classifier
separates its two sides; a decision with a close runner-up is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeel.llm.common import mixed, pick, pieces, position, text_bytes, training_row, unused

UNKNOWN = "und"
#: Learning from more languages than this is refused: their counts are held by the driver.
MOST_LANGUAGES = 1000


def codewords(n: int) -> np.ndarray:
    """A matrix of +1 and -1 with a row for each of n languages, far from each other.

    Up to six languages have all ways to divide them into two sides; more have the rows
    of a Hadamard matrix without its constant column.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        masks = np.arange(1, 2 ** (n - 1))
        return np.where(masks[None, :] >> np.arange(n)[:, None] & 1, -1.0, 1.0)
    matrix = np.ones((1, 1))
    while len(matrix) < n:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    code = matrix[:n, 1:]
    return code[:, np.abs(code.sum(axis=0)) < n]


def _letters() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for i in range(97, 123):
        table[i] = table[i - 32] = i
    return table


_LETTERS = _letters()
_WINDOW = 1 << 20


def grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n-grams of two and of three bytes: their buckets, and for each text the number before it.

    Letters are lower-cased where UTF-8 has them in ASCII and Latin-1; all else in ASCII is
    a gap. Comes in windows of a bounded number of bytes, for texts of any length.
    """
    b = _LETTERS[data]
    b[1:][(b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)] += 32
    for at in range(0, len(b), _WINDOW):
        size = min(_WINDOW, len(b) - at)
        x = np.zeros(size + 2, dtype=np.uint64)
        x[: len(b) - at] = b[at : at + size + 2]
        ends = np.repeat(offsets[1:], np.diff(np.clip(offsets, at, at + size)))
        left = ends - np.arange(at, at + size)  # bytes up to the end of the text
        code = x[:size]
        for n in (1, 2):
            code = code << np.uint64(8) | x[n : n + size]
            inside = np.flatnonzero((left > n) & ((x[:size] != 32) | (x[n : n + size] != 32)))
            bucket = mixed(code[inside] * np.uint64(4) + np.uint64(n)) >> np.uint64(64 - bits)
            yield bucket.astype(np.int64), np.searchsorted(inside + at, offsets)


@dataclass
class LanguageModel:
    """Languages, their codewords, weights of n-gram buckets for each bit, and how much each bit counts."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray
    bits: int
    ambiguous_below: float

    def decide(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the index of its language, and the share of belief in it."""
        total = np.zeros(len(offsets) - 1)
        margin = np.zeros((len(total), self.weights.shape[1]))
        for key, start in grams(data, offsets, self.bits):
            count = np.diff(start)
            total += count
            some = np.flatnonzero(count)
            if len(some):
                margin[some] += np.add.reduceat(self.weights[key], start[:-1][some], axis=0)
        # n-grams of a text overlap, so that a long text is not so much surer than a hundred of them.
        margin *= np.minimum(1.0, 100 / np.maximum(total, 1))[:, None] / 2
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None, :, :]) @ self.bit_weights
        belief = np.exp(loss.min(axis=1, keepdims=True) - loss)
        belief /= belief.sum(axis=1, keepdims=True)
        best = belief.argmax(axis=1)
        return best, belief[np.arange(len(best)), best]


def learn_languages(
    docs: DataFrame,
    only: Column | None = None,
    *,
    sample_rows: int = 20_000,
    bits: int = 16,
    ambiguous_below: float = 0.6,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LanguageModel:
    """Learn from texts with a language, chosen by a hash of doc_id, about sample_rows of them at most.

    only: a condition on the columns doc_id, text and lang. Rows without text, language
    or doc_id teach nothing. Counts of n-grams are summed by Spark; the driver gets one
    number for each language and bucket that occurs. Without any such row the model
    knows no language and answers "und".
    """
    rows = pick(docs, doc_id=doc_id, text=text, lang=lang)
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if only is not None:
        rows = rows.where(only)
    per_lang = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).take(MOST_LANGUAGES + 1)}
    if len(per_lang) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(per_lang)
    scale = 1 << 30
    # Each language has an equal part of the sample, as far as it has the rows.
    share = {k: min(scale, scale * sample_rows // (len(languages) * n)) for k, n in per_lang.items()}
    limit = F.lit(0)
    for k in languages:
        limit = F.when(F.col("lang") == k, share[k]).otherwise(limit)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < limit).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, "text"):
                names = np.array(part.column("lang").to_pylist(), dtype=object)
                for key, start in grams(*text_bytes(part.column("text")), bits):
                    for language in set(names):
                        own = np.repeat(names == language, np.diff(start))
                        totals.setdefault(language, np.zeros(1 << bits, dtype=np.int64))
                        totals[language] += np.bincount(key[own], minlength=1 << bits)
        for language, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    sums = chosen.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((len(languages), 1 << bits), 0.05)
    found = sums.toArrow() if languages else None
    if found is not None and len(found):
        place = {k: i for i, k in enumerate(languages)}
        at = np.array([place[k] for k in found.column("lang").to_pylist()])
        table[at, found.column("bucket").to_numpy()] += found.column("n").to_numpy()
    share_of = table / table.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights, strength = np.zeros((1 << bits, code.shape[1])), np.ones(code.shape[1])
    for k in range(code.shape[1]):
        if (code[:, k] > 0).any() and (code[:, k] < 0).any():
            right, wrong = share_of[code[:, k] > 0].mean(axis=0), share_of[code[:, k] < 0].mean(axis=0)
            weights[:, k] = np.log(right / wrong)
            strength[k] = ((right - wrong) * weights[:, k]).sum()
    return LanguageModel(languages, code, weights.astype(np.float32), strength / strength.mean(), bits, ambiguous_below)


def predict_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and ambiguous added (under names with "_" appended where docs has such columns).

    score is the share of belief in the chosen language, 0 to 1; ambiguous is set below
    the model's threshold. A null text, one without any letter, or a model without
    languages gives "und", 0.0 and true. No shuffle; a task holds one Arrow batch.
    """
    names = list(docs.columns)
    place = position(docs, text)
    new = [unused(docs, n) for n in ("lang_pred", "score", "ambiguous")]
    numbered = docs.toDF(*[f"_{i}" for i in range(len(names))])
    numbered = numbered.withColumn("has_letter", F.coalesce(F.col(f"_{place}").rlike(r"\p{L}"), F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        labels = [*own.languages, UNKNOWN]
        for batch in batches:
            for part in pieces(batch, f"_{place}"):
                known = np.array(part.column("has_letter").to_pylist(), dtype=bool)
                if own.languages:
                    best, belief = own.decide(*text_bytes(part.column(f"_{place}")))
                else:
                    best, belief = np.zeros(len(part), dtype=int), np.zeros(len(part))
                    known[:] = False
                best, belief = np.where(known, best, len(labels) - 1), np.where(known, belief, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(f"_{i}") for i in range(len(names))],
                        pa.array([labels[i] for i in best], pa.string()),
                        pa.array(belief, pa.float64()),
                        pa.array(~known | (belief < own.ambiguous_below), pa.bool_()),
                    ],
                    names=[*[f"_{i}" for i in range(len(names))], "p", "s", "a"],
                )

    kinds = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    return numbered.mapInArrow(decide, f"{kinds}, p string, s double, a boolean").toDF(*names, *new)


def identify_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous; learned from the rows that are not held out."""
    model = learn_languages(docs, training_row(F.col("doc_id")))
    rows = predict_languages(pick(docs, doc_id="doc_id", text="text"), model)
    return rows.select("doc_id", (~training_row(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "ambiguous")
