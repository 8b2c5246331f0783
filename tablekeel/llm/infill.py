"""Fill-in-middle: a text is cut into prefix, middle and suffix, and put together again in another order.

A cut stands after so many code points. Where that is in the UTF-8 bytes is found eight
bytes at a time: the bytes of a whole batch of texts are viewed as 64-bit words, the bytes
that end a code point are marked in each word by arithmetic, marks are counted per word, a
search in the running counts gives the word of a cut, and a select within the word its byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeel.llm.common import pick, pieces, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_ONES = np.uint64(0x0101010101010101)
_LEAST = np.arange(8, dtype=np.uint64) * np.uint64(8)


class CodePoints:
    """Where code points end in texts that lie one after another as UTF-8."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.offsets = offsets
        padded = np.zeros(-(-len(data) // 8) * 8 + 8, dtype=np.uint8)
        padded[: len(data)] = data
        words = padded.view("<u8")
        # A byte begins a code point unless its highest bits are 10; it ends one if the next byte begins one.
        begins = ~((words >> np.uint64(7)) & ~(words >> np.uint64(6))) & _ONES
        self.ends = (begins[:-1] >> np.uint64(8)) | (begins[1:] << np.uint64(56))
        if len(data) % 8:  # past the last byte, which ends one, nothing does
            self.ends[-1] &= np.uint64((1 << 8 * (len(data) % 8)) - 1)
        self.before = np.zeros(len(self.ends) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.ends), out=self.before[1:])
        self.first = self.rank(offsets)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """How many code points end before each byte."""
        word, inside = places >> 3, ((places & 7) * 8).astype(np.uint64)
        ends = np.append(self.ends, np.uint64(0))[word]
        return self.before[word] + np.bitwise_count(ends & ((np.uint64(1) << inside) - np.uint64(1)))

    def counts(self) -> np.ndarray:
        """The code points of each text."""
        return np.diff(self.first)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The byte, from the beginning of its text, after so many code points of each text."""
        wanted = self.first[:-1] + units
        word = np.maximum(np.searchsorted(self.before, wanted, side="left") - 1, 0)
        left = (wanted - self.before[word]).astype(np.uint64)
        with np.errstate(over="ignore"):  # byte j of the product holds the marks of bytes 0 to j
            so_far = np.append(self.ends, np.uint64(0))[word] * _ONES
        reached = ((so_far[:, None] >> _LEAST) & np.uint64(255)) >= left[:, None]
        place = (word << 3) + np.argmax(reached, axis=1) + 1
        return np.where(units > 0, place - self.offsets[:-1], 0)


@dataclass(frozen=True)
class Forms:
    """How often texts stay plain, and how often the others begin with the suffix, in hundredths; seed: of the hashes."""

    seed: int = 1
    plain_from: int = 90
    suffix_first_below: int = 20


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers: the first hexadecimal digits of a SHA-256 of seed and id; a null id is an empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4]) for i in (0, 4, 8, 12))


def _forms(batches: Iterator[pa.RecordBatch], how: Forms) -> Iterator[pa.RecordBatch]:
    tags = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for part in (p for batch in batches for p in pieces(batch, "text")):
        data, offsets = text_bytes(part.column("text"))
        points = CodePoints(data, offsets)
        ids = part.column("doc_id").to_pylist()
        drawn = np.array([draws(how.seed, i) for i in ids], dtype=np.int64).reshape(-1, 4)
        n = points.counts()
        one, two = drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)
        low, high = np.minimum(one, two), np.maximum(one, two)
        cuts = zip(offsets[:-1].tolist(), offsets[1:].tolist(), points.cut(low).tolist(), points.cut(high).tolist(), strict=True)
        raw = data.tobytes()
        forms, outputs = [], []
        for (begin, end, a, b), (_, _, h3, h4) in zip(cuts, drawn.tolist(), strict=True):
            text = raw[begin:end]
            if not text or h3 % 100 >= how.plain_from or any(tag in text for tag in tags):
                forms.append("plain")
                outputs.append(text)
                continue
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            if h4 % 100 < how.suffix_first_below:
                forms.append("spm")
                outputs.append(b"".join((tags[1], suffix, tags[0], prefix, tags[2], middle)))
            else:
                forms.append("psm")
                outputs.append(b"".join((tags[0], prefix, tags[1], suffix, tags[2], middle)))
        plain = np.array([f == "plain" for f in forms], dtype=bool)
        columns = {
            "doc_id": part.column("doc_id"),
            "n": pa.array(n, pa.int64()),
            "form": pa.array(forms, pa.string()),
            "prefix_chars": pa.array(low, pa.int64(), mask=plain),
            "middle_chars": pa.array(high - low, pa.int64(), mask=plain),
            "output": pa.array(outputs, pa.binary()).cast(pa.string()),
        }
        yield pa.RecordBatch.from_pydict(columns)


def fill_in_middle(docs: DataFrame, how: Forms = Forms(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars and output, a row for each row of docs.

    Two numbers drawn from the id say after how many code points prefix and middle end.
    psm has prefix, suffix and middle, each after its sign, and spm the suffix first. A text
    that is null, empty or holds one of the signs stays plain, as does a share of the
    others; its two lengths are null. Rows of the same id are cut by the same draws, and
    rows with a null id by those of an empty id. There is no shuffle; a task holds one
    piece of a batch, of about a megabyte, or else one text.
    """
    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(lambda batches: _forms(batches, how), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of that form was made of; the signs stand once each in what is not plain."""
    first = F.substr(output, F.lit(len(PREFIX) + 1))
    second = F.when(form == "psm", SUFFIX).otherwise(PREFIX)
    at, then = F.position(second, first), F.position(F.lit(MIDDLE), first)
    head = F.substr(first, F.lit(1), at - 1)
    tail = F.substr(first, at + len(SUFFIX), then - at - len(SUFFIX))
    middle = F.substr(first, then + len(MIDDLE))
    return F.when(form == "psm", F.concat(head, middle, tail)).when(form == "spm", F.concat(tail, middle, head)).otherwise(output)


def with_digests(filled: DataFrame) -> DataFrame:
    """Lower-case SHA-256 digests of the output and of the text restored from it, in place of the output."""
    digests = [
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    ]
    return filled.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def oracle() -> str:
    """The same in DuckDB, over the table documents."""
    draw = "CAST('0x' || substr(h, {}, 8) AS UBIGINT)"
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    d AS (SELECT doc_id, text, n, {draw.format(1)} % (n + 1) AS a, {draw.format(9)} % (n + 1) AS b,
        {draw.format(17)} % 100 AS c, {draw.format(25)} % 100 AS e FROM t),
    f AS (SELECT doc_id, text, n, least(a, b) AS low, greatest(a, b) AS high,
        CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
            OR c >= 90 THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (SELECT *, substr(text, 1, CAST(low AS BIGINT)) AS prefix, substr(text, CAST(low AS BIGINT) + 1, CAST(high - low AS BIGINT)) AS middle,
        substr(text, CAST(high AS BIGINT) + 1) AS suffix FROM f)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
        CASE WHEN form <> 'plain' THEN CAST(low AS BIGINT) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN CAST(high - low AS BIGINT) END AS middle_chars,
        sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
            WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle ELSE text END) AS output_sha256,
        sha256(text) AS restored_sha256 FROM p"""
