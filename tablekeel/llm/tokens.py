"""Token counts by a whole-token shortcut.

A sentencepiece BPE model joins pieces within a text wherever its vocabulary has the
joined string. If no piece holds a space after another character, nothing is ever joined
across the place before a space, so a text falls into pre-tokens, each a run of spaces and
what follows, that are encoded alone; the same holds on both sides of a line feed that no
piece contains. ``proven_tokens`` checks these conditions and finds the pre-tokens that
the library itself encodes as a single token. Those are counted by lookup; only the rest
are merged by the library, each distinct one once while it stays in a bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tablekeel.llm.common import pick

SPACE = "▁"
#: Pre-tokens that a worker remembers beside the proven ones, and the length up to which it does.
REMEMBERED, REMEMBERED_CHARS = 400_000, 64


def proven_tokens(processor) -> dict[str, int]:
    """The pre-tokens that encode alone as one token, each with 1; ValueError if pre-tokens are not independent.

    The model adds a space before a text, so what is encoded to prove "▁word" is "word".
    """
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    plain = [p for i, p in enumerate(pieces) if not processor.is_control(i) and not processor.is_unknown(i)]
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain):
        raise ValueError("a piece holds a space after another character: pre-tokens depend on each other")
    if any("\n" in p for p in plain):
        raise ValueError("a piece holds a line feed: lines depend on each other")
    if len(processor.encode("\n", num_threads=1)) != 2 or len(processor.encode(" x", num_threads=1)) < 2:
        raise ValueError("the model drops white space")
    candidates = [p for p in plain if p.startswith(SPACE) and len(p) > 1]
    alone = processor.encode([p[1:].replace(SPACE, " ") for p in candidates], num_threads=1)
    return {p.replace(SPACE, " "): 1 for p, ids in zip(candidates, alone, strict=True) if len(ids) == 1}


class TokenCounts(dict):
    """Pre-token to its number of tokens; what is not proven is encoded when it is first met."""

    split = re.compile(r" +[^ \n]*|\n[^ \n]*").findall

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.proven = proven_tokens(self.processor)
        super().__init__(self.proven)

    def __missing__(self, word: str) -> int:
        # The space that the model adds stands for the first one here, or is a token of its own before a line feed.
        if word[0] == " ":
            count = len(self.processor.encode(word[1:], num_threads=1)) if len(word) > 1 else 1
        else:
            count = len(self.processor.encode(word, num_threads=1)) - 1
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= len(self.proven) + REMEMBERED:
                self.clear()
                self.update(self.proven)
            self[word] = count
        return count

    def of(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.split(" " + text.replace(SPACE, " "))))


@lru_cache(maxsize=2)
def counts_of(model: str) -> TokenCounts:
    return TokenCounts(model)


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    model is the path of a sentencepiece BPE model, the same on all executors. No begin
    or end tokens; special strings inside texts are ordinary text. A null text counts as
    empty: 0 bytes and 0 tokens. A null or repeated doc_id is passed on as it is. There
    is no shuffle, and a task holds one Arrow batch at a time.
    """
    rows = pick(docs, doc_id=doc_id, text=text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counts_of(model).of
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = [of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
