"""Collocations: phrases that occur often, and more often than their parts would by chance.

Frequent phrases are mined by partitioning (SON). The corpus is dealt into a fixed number
of shards, and each is mined on its own at a support lowered to its share of the words: a
phrase that is frequent in all is so in one shard at least. Within a shard longer phrases
are counted only where all their words, then all their pairs of words, are frequent in
some shard. The union of what the shards found is then counted exactly in the whole corpus.

What a task has to know of the phrases found so far is a bitmap of fixed size. A phrase
that has been found is always in it; one that shares a bit by chance costs counting, and is
dropped by its exact count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablekeel.llm.common import WordHasher, cut, mixed, pick, pieces, text_bytes

#: Words, and the characters that end a piece, in Java's and RE2's syntax.
SINGLE = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
#: More combinations of shard and language than this are refused: their sums, a row each, are held by the driver.
MOST_CELLS = 100_000
#: Distinct phrases that a task holds before it hands on what it has counted.
MOST_KEYS, MOST_PHRASES = 1 << 22, 1 << 19
#: Splits of the input that a task reads, where there are more than two for each core.
SPLITS = 4

_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Least occurrences, most words of a phrase, rows per language, shards, and bits (a power of two) of a bitmap."""

    support: int = 100
    longest: int = 5
    top: int = 2000
    shards: int = 16
    filter_bits: int = 26


class PhraseHasher(WordHasher):
    """Words of pieces, and 64-bit keys of the phrases that begin with each."""

    def __init__(self) -> None:
        super().__init__()
        self.ends_piece = np.zeros(256, dtype=bool)
        self.ends_piece[[*b".,;:!?", 10, 11, 12, 13]] = True
        self.space = self.ends_piece.copy()
        self.space[[9, 32]] = True

    def phrases(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray) -> Phrases:
        """seeds: a number for each text, by which equal words of unlike languages get unlike keys."""
        starts, ends = self.words(data, offsets)
        of = np.searchsorted(offsets[1:], starts, side="right")
        breaks = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(self.ends_piece[data], out=breaks[1:])
        joined = np.zeros(len(starts), dtype=bool)
        joined[:-1] = (of[1:] == of[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]])
        keys = mixed(self.hashes(data, starts, ends) ^ seeds[of])
        return Phrases(starts, ends, of, joined, keys)


@dataclass
class Phrases:
    """Places and texts of words, whether the next word is of the same piece, and the words' keys."""

    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray
    joined: np.ndarray
    keys: np.ndarray

    def of_length(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length the keys of all phrases, by their first words, and whether there is such a phrase."""
        keys, there = self.keys, np.ones(len(self.keys), dtype=bool)
        yield 1, keys, there
        for k in range(2, most + 1):
            keys, there = keys.copy(), there.copy()
            last = max(0, len(keys) - k + 1)
            there[:last] &= self.joined[k - 2 : k - 2 + last]
            there[last:] = False
            keys[:last] = mixed(keys[:last] * _ODD + self.keys[k - 1 : k - 1 + last])
            yield k, keys, there


def within(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for each key; a row for each 64 bits that are not all unset comes to the driver, 2 ** (bits - 6) at most."""
    at = F.col("key").bitwiseAND((1 << bits) - 1)
    bit = F.expr("shiftleft(1L, CAST(key & 63 AS INT))")
    rows = keys.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


class Tally:
    """Occurrences by key, and the cell that each key belongs to."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, cells: np.ndarray, n: np.ndarray | None = None) -> None:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0) if len(keys) else order
        if n is None:
            counts = np.diff(np.append(first, len(keys)))
        else:
            counts = np.add.reduceat(n[order], first) if len(keys) else n
        self.parts.append((keys[first], cells[order[first]], counts.astype(np.int64)))
        self.size += len(first)

    def merge(self) -> None:
        if self.parts:
            keys, cells, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            self.__init__()
            self.add(keys, cells, n)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.merge()
            keys, cells, n = self.parts[0]
            for i in range(0, len(keys), 1 << 18):
                part = slice(i, i + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(cells[part], pa.int32()), pa.array(keys[part].view(np.int64)), pa.array(n[part])], ["cell", "key", "n"])
        self.__init__()


@dataclass
class Corpus:
    """Documents with their shard; words by language, tasks of the last pass, and least occurrences by shard and language."""

    rows: DataFrame
    rule: Rule
    words: dict[str, int]
    tasks: int
    least: DataFrame

    @property
    def langs(self) -> list[str]:
        return list(self.words)


def open_corpus(docs: DataFrame, rule: Rule, text: str, lang: str) -> Corpus:
    """Shards are files, dealt to a fixed number; rows that come from no file are all of one shard."""
    spark = docs.sparkSession
    rows = pick(docs, text=text, lang=lang)
    shard = F.pmod(F.xxhash64(F.input_file_name()), F.lit(rule.shards)).cast("int")
    rows = rows.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), shard.alias("shard"))
    words_of = F.sum(F.regexp_count("text", F.lit(SINGLE))).cast("long").alias("words")
    sums = rows.withColumn("split", F.spark_partition_id()).groupBy("shard", "lang").agg(words_of, F.max("split").alias("last")).take(MOST_CELLS + 1)
    if len(sums) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} combinations of shard and language")
    words = dict.fromkeys(sorted({r.lang for r in sums}), 0)
    for r in sums:
        words[r.lang] += r.words
    index = {lang: i for i, lang in enumerate(words)}
    least = [(index[r.lang] * rule.shards + r.shard, max(1, -(-rule.support * r.words // max(1, words[r.lang])))) for r in sums]
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-max((r.last + 1 for r in sums), default=1) // SPLITS))
    return Corpus(rows, rule, words, tasks, spark.createDataFrame(least, "cell int, least long"))


def _parts(batches: Iterator[pa.RecordBatch], langs: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, Phrases]]:
    """For each piece of a batch: its bytes, the language and shard of its texts, and its phrases."""
    hasher, known = PhraseHasher(), pa.array(langs, pa.string())
    seeds = mixed(np.arange(1, len(langs) + 1, dtype=np.uint64) * _ODD)
    for part in (p for batch in batches for p in pieces(batch, "text")):
        data, offsets = text_bytes(part.column("text"))
        lang = pc.index_in(part.column("lang"), value_set=known).to_numpy()
        yield data, lang, part.column("shard").to_numpy(), hasher.phrases(data, offsets, seeds[lang])


def found_in_shards(corpus: Corpus, lengths: range, parts: np.ndarray | None) -> DataFrame:
    """key of each phrase of these lengths that is frequent in some shard, at the support of its share, and in all together.

    Every shard counts all phrases whose parts are frequent, so that the sums over the shards
    already drop most of what one of them has found alone. parts: the bitmap of what all words (for pairs of words) or all pairs of words (for
    longer phrases) have to be in; without it all phrases are counted.
    """
    rule, langs = corpus.rule, corpus.langs
    shared = None if parts is None else corpus.rows.sparkSession.sparkContext.broadcast(parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[int, Tally] = {}
        for _, lang, shard, found in _parts(batches, langs):
            cell = (lang * rule.shards + shard)[found.of].astype(np.int32)
            for k, keys, there in found.of_length(lengths[-1]):
                if shared is not None and k == (1 if lengths[0] == 2 else 2):
                    good = there & within(shared.value, keys)
                if k not in lengths:
                    continue
                if shared is not None:  # the phrase's words, or pairs of words, are those at its first word and after
                    steps = 2 if lengths[0] == 2 else k - 1
                    there = there.copy()
                    for step in range(steps):
                        there[: max(0, len(good) - step)] &= good[step:]
                for s in np.unique(shard):
                    at = np.flatnonzero(there & (shard[found.of] == s))
                    tallies.setdefault(int(s), Tally()).add(keys[at], cell[at])
            if sum(t.size for t in tallies.values()) > MOST_KEYS:
                for t in tallies.values():
                    t.merge()
                if sum(t.size for t in tallies.values()) > MOST_KEYS // 2:
                    for t in tallies.values():
                        yield from t.batches()
        for t in tallies.values():
            yield from t.batches()

    # Tasks have summed up what they read; dealt by key, the sums of shards and those of all are made in one place.
    counted = corpus.rows.mapInArrow(count, "cell int, key long, n long").repartition("key")
    by_shard = counted.groupBy("key", "cell").agg(F.sum("n").alias("n")).join(F.broadcast(corpus.least), "cell")
    everywhere = by_shard.groupBy("key").agg(F.max(F.col("n") >= F.col("least")).alias("local"), F.sum("n").alias("n"))
    return everywhere.where(F.col("local") & (F.col("n") >= rule.support)).select("key")


def count_everywhere(corpus: Corpus, found: np.ndarray) -> DataFrame:
    """lang, words, phrase and n of all phrases with the support, counted exactly where they and their parts are in the bitmap.

    Within a task, phrases are told apart by 64-bit keys; between tasks, by their text.
    """
    rule, langs = corpus.rule, corpus.langs
    shared = corpus.rows.sparkSession.sparkContext.broadcast(found)

    def batch_of(held: dict[int, list]) -> pa.RecordBatch:
        lang, words, phrase, n = zip(*held.values(), strict=True)
        phrases = pa.array(phrase, pa.binary()).cast(pa.string())
        arrays = [pa.array([langs[i] for i in lang], pa.string()), pa.array(words, pa.int32()), phrases, pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "words", "phrase", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for data, lang, _, there_are in _parts(batches, langs):
            raw, good = data.tobytes().lower(), None
            for k, keys, there in there_are.of_length(rule.longest):
                if good is not None:  # a phrase is as frequent as its two longest parts at most
                    there = there & good & np.append(good[1:], False)[: len(good)]
                good = there & within(shared.value, keys)
                at = np.flatnonzero(good)
                order = at[np.argsort(keys[at], kind="stable")]
                first = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]) != 0)
                counts = np.diff(np.append(first, len(order)))
                places = order[first]
                spans = zip(there_are.starts[places].tolist(), there_are.ends[places + k - 1].tolist(), there_are.of[places].tolist(), strict=True)
                for key, n, (begin, end, of) in zip(keys[places].tolist(), counts.tolist(), spans, strict=True):
                    if (old := held.get(key)) is not None:
                        old[3] += n
                    else:
                        held[key] = [lang[of], k, b" ".join(raw[begin:end].split()) if k > 1 else raw[begin:end], n]
            if len(held) > MOST_PHRASES:
                yield batch_of(held)
                held = {}
        if held:
            yield batch_of(held)

    # A task hands on each phrase that it has seen once, so it reads several splits where there are many.
    counted = corpus.rows.coalesce(corpus.tasks).mapInArrow(count, "lang string, words int, phrase string, n long")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= rule.support)


def frequent_phrases(docs: DataFrame, rule: Rule = Rule(), text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases with the support (lang, words, phrase, n), kept in the shared folder, and the words of each language (lang, total)."""
    corpus = open_corpus(docs, rule, text, lang)
    single = bitmap_of(found_in_shards(corpus, range(1, 2), None), rule.filter_bits)
    filters = [single]
    if rule.longest > 1:
        filters.append(bitmap_of(found_in_shards(corpus, range(2, 3), single), rule.filter_bits))
    if rule.longest > 2:
        filters.append(bitmap_of(found_in_shards(corpus, range(3, rule.longest + 1), filters[1]), rule.filter_bits))
    counts = cut(count_everywhere(corpus, reduce(np.bitwise_or, filters)))
    totals = docs.sparkSession.createDataFrame(list(corpus.words.items()), "lang string, total long")
    return counts, totals


def collocations(docs: DataFrame, rule: Rule = Rule(), text: str = "text", lang: str = "lang") -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n and score.

    a, l and r are the occurrences of the phrase and of the two parts that its lowest-scoring
    cut leaves (the first of equal ones), n the words of the language, and score
    floor(1000 * a * n / (l * r)). A phrase that occurs only within one longer candidate is
    left out. Ties in score and a go by the bytes of the phrase. Rows of a null language are
    of the language ``und``; null and empty texts have no words; rows may repeat, and other
    columns do not matter. Without a frequent phrase there are no rows.
    """
    counts, totals = frequent_phrases(docs, rule, text, lang)
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        F.expr("array_join(slice(w, 1, cut), ' ')").alias("left"),
        F.expr("array_join(slice(w, cut + 1, words - cut), ' ')").alias("right"),
    )
    part = lambda side, n: counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast(T.DecimalType(38, 0))
    cuts = cuts.join(F.broadcast(totals.withColumnRenamed("total", "n")), "lang")
    above, below = F.lit(1000).cast(T.DecimalType(38, 0)) * wide("a") * wide("n"), wide("l") * wide("r")
    cuts = cuts.withColumn("above", above).withColumn("below", below).withColumn("score", F.expr("above div below"))
    least = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))

    longer = candidates.where("words > 2").withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
    longer = longer.withColumn("at", F.explode(F.expr("sequence(1, words - size + 1)")))
    longer = longer.select("lang", F.expr("array_join(slice(w, at, size), ' ')").alias("phrase"), "a")
    covered = longer.groupBy("lang", "phrase").agg(F.max("a").alias("inside"))
    kept = least.join(covered, ["lang", "phrase"], "left").where("inside IS NULL OR inside < a")

    order = Window.partitionBy("lang").orderBy(F.desc("s.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "s.l", "s.r", "n", F.col("s.score").cast("long").alias("score"))


def oracle() -> str:
    """The same in DuckDB, over the table documents, by counting all phrases."""
    return r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
    g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
    x AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS k FROM g),
    f AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS a FROM x GROUP BY ALL),
    t AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 100),
    cuts AS (SELECT lang, phrase, k, a, ws, unnest(range(1, k)) AS pos FROM c),
    scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, pos, l.a AS l, r.a AS r, n,
        (1000::HUGEINT * cuts.a * n) // (l.a::HUGEINT * r.a) AS score FROM cuts
        JOIN f AS l ON l.lang = cuts.lang AND l.phrase = array_to_string(ws[1 : pos], ' ')
        JOIN f AS r ON r.lang = cuts.lang AND r.phrase = array_to_string(ws[pos + 1 : cuts.k], ' ')
        JOIN t ON t.lang = cuts.lang),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) = 1),
    sizes AS (SELECT lang, ws, a, k, unnest(range(2, k)) AS size FROM c WHERE k > 2),
    inside AS (SELECT lang, ws, a, size, unnest(range(1, k - size + 2)) AS pos FROM sizes),
    covered AS (SELECT lang, array_to_string(ws[pos : pos + size - 1], ' ') AS phrase, max(a) AS inside FROM inside GROUP BY ALL),
    kept AS (SELECT lowest.* FROM lowest LEFT JOIN covered USING (lang, phrase) WHERE inside IS NULL OR inside < a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
        CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""
