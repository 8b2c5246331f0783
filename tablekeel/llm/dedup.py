"""Near-duplicates by MinHash with sequential Bayesian verification.

1. Each text becomes a set of hashed word shingles, and equal sets become one class.
2. Each class has a MinHash signature. Bands of it propose candidates: within each bucket
   of a band, all classes are compared with the bucket's centre, the class that shares
   most buckets with others.
3. A candidate's signatures are compared batch by batch. After each batch the posterior of
   the similarity, given the matches so far and a uniform prior, says whether it can still
   reach the threshold; below the chosen miss probability the pair is dropped.
4. Survivors are verified on their whole sets, and connected components are found.
5. In buckets that still hold several components, all classes of different components are
   compared and verified the same way, in blocks of bounded size, so that no link depends
   on the centre.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeel.llm.common import WordHasher, cut, mixed, pick, pieces, small, text_bytes

#: Classes, and shingles of all of them, of one side of a block comparison, on average.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Pairs whose signatures are compared at once.
CHUNK = 1 << 16
ROWS_IN_BAND = 5
#: Signature values that are compared before the posterior is looked at again.
BATCH = 24


@dataclass(frozen=True)
class Rule:
    """What is linked: words of a shingle, the least similarity in percent, and the chances of missing a link.

    miss: the probability that a pair at the threshold shares no band. prune: the posterior
    probability of a link below which a candidate is dropped unverified.
    """

    words: int = 5
    percent: int = 80
    miss: float = 1e-6
    prune: float = 1e-7

    @property
    def bands(self) -> int:
        return max(1, math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** ROWS_IN_BAND)))

    @property
    def functions(self) -> int:
        return -(-self.bands * ROWS_IN_BAND // BATCH) * BATCH

    def least_matches(self) -> list[int]:
        """For each batch the number of matches so far below which the posterior of a link is under prune.

        The posterior after m of n matches is Beta(m + 1, n - m + 1), whose upper tail at t is
        the probability that a binomial of n + 1 trials with chance t has at most m successes.
        """
        t, out = self.percent / 100, []
        for n in range(BATCH, self.functions + 1, BATCH):
            tail, m = 0.0, 0
            while m <= n:
                tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
                if tail >= self.prune:
                    break
                m += 1
            out.append(m)
        return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and for each text the number before it."""
    hashes, first = hasher(data, offsets)
    count = np.diff(first)
    whole = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    before = np.concatenate([[0], np.cumsum(whole)])
    text = np.repeat(np.arange(len(count)), whole)
    at = np.repeat(first[:-1] - before[:-1], whole) + np.arange(before[-1])
    out = np.zeros(len(at), dtype=np.uint64)
    last = first[1:][text]
    for k in range(words):
        inside = at + k < last
        value = np.zeros(len(at), dtype=np.uint64)
        value[inside] = hashes[(at + k)[inside]]
        out = (out + value) * np.uint64(0x9E3779B97F4A7C15) + inside.astype(np.uint64)
        out ^= out >> np.uint64(29)
    out = mixed(out)
    order = np.lexsort((out, text))
    out, text = out[order], text[order]
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return out[keep], np.concatenate([[0], np.cumsum(np.bincount(text[keep], minlength=len(count)))])


def class_of(shingles: np.ndarray) -> bytes:
    """The name of a set: 16 bytes of a digest of its sorted hashes."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(shingles: np.ndarray, before: np.ndarray, functions: int) -> np.ndarray:
    """For each text that has shingles, the least value of each hash function."""
    out = np.empty((len(before) - 1, functions), dtype=np.uint64)
    factors = mixed(np.arange(1, functions + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
    shifts = mixed(factors)
    for k in range(functions):
        out[:, k] = np.minimum.reduceat((shingles ^ shifts[k]) * factors[k], before[:-1])
    return out


def describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, cls, sig and keys; the last three null without words or id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        factors = mixed(np.arange(1, ROWS_IN_BAND + 1, dtype=np.uint64)) | np.uint64(1)
        salt = mixed(np.arange(rule.bands, dtype=np.uint64) + np.uint64(99))
        for batch in batches:
            for part in pieces(batch, "text"):
                found, before = shingle_sets(*text_bytes(part.column("text")), rule.words, hasher)
                count = np.diff(before)
                some = np.flatnonzero((count > 0) & part.column("doc_id").is_valid().to_numpy(zero_copy_only=False))
                names, sigs, keys = ([None] * len(part) for _ in range(3))
                if len(some):
                    own = np.concatenate([found[before[i] : before[i + 1]] for i in some])
                    least = signatures(own, np.concatenate([[0], np.cumsum(count[some])]), rule.functions)
                    banded = least[:, : rule.bands * ROWS_IN_BAND].reshape(len(some), rule.bands, ROWS_IN_BAND)
                    banded = mixed((banded * factors).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)
                    short = (least >> np.uint64(20)).astype(np.uint16)
                    for k, i in enumerate(some):
                        names[i] = class_of(found[before[i] : before[i + 1]])
                        sigs[i] = short[k].tobytes()
                        keys[i] = banded[k]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(count, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(sigs, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "cls", "sig", "keys"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(work, f"doc_id {kind}, n_shingles long, cls binary, sig binary, keys array<bigint>")


def likely(a: np.ndarray, b: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signatures survive all batches, and their matches. Sizes too far apart cannot reach the threshold."""
    alive = np.flatnonzero(100 * np.minimum(*sizes) >= rule.percent * np.maximum(*sizes))
    matches = np.zeros(len(alive), dtype=np.int32)
    for k, least in enumerate(rule.least_matches()):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[alive, part] == b[alive, part]).sum(axis=1, dtype=np.int32)
        stay = matches >= least
        alive, matches = alive[stay], matches[stay]
    return alive, matches


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), -1)


def prune_pairs(pairs: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose signatures may belong to a link."""
    for side in ("a", "b"):
        own = reps.select(F.col("cls").alias(side), F.col("sig").alias(f"sig_{side}"), F.col("n_shingles").alias(f"n_{side}"))
        pairs = pairs.join(own, side)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                sizes = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                alive, _ = likely(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), sizes, rule)
                yield batch.select(["a", "b"]).take(pa.array(alive))

    return pairs.select("a", "b", "sig_a", "sig_b", "n_a", "n_b").mapInArrow(work, "a binary, b binary")


def sets_of(wanted: DataFrame, docs: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """Per wanted class (cls): cls and shingles, ascending, made again from the text of one of its documents."""
    wanted = cut(wanted.distinct().join(reps.select("cls", F.col("least").alias("doc_id")), "cls"))
    rows = docs.join(small(wanted), "doc_id").select("text", "cls")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for part in pieces(batch, "text"):
                found, before = shingle_sets(*text_bytes(part.column("text")), rule.words, hasher)
                names = part.column("cls").to_pylist()
                sets = [found[x:y] for x, y in zip(before[:-1], before[1:], strict=True)]
                # An id that stands on rows with different texts is wanted for one of them.
                right = [i for i, own in enumerate(sets) if class_of(own) == names[i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[i] for i in right], pa.binary()),
                        pa.array([sets[i].view(np.int64) for i in right], pa.list_(pa.int64())),
                    ],
                    names=["cls", "shingles"],
                )

    return rows.mapInArrow(work, "cls binary, shingles array<bigint>").dropDuplicates(["cls"])


def verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by their whole sets."""
    # Kept as files: a join of its own exchange is one that Spark can split where a class has many pairs.
    sets = cut(sets_of(pairs.select(F.explode(F.array("a", "b")).alias("cls")), docs, reps, rule))
    for side in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("cls").alias(side), F.col("shingles").alias(f"s_{side}")), side)
    both = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - both
    return cut(pairs.where(100 * both.cast("long") >= rule.percent * union.cast("long")).select("a", "b"))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (u, v), u > v, are stars: each u has one v, which is no u itself and so the least that can be reached."""
    above = F.struct(F.col("u").alias("node"), F.lit(1).alias("up"))
    below = F.struct(F.col("v").alias("node"), F.lit(0).alias("up"))
    ends = edges.select(F.inline(F.array(above, below)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return ends.where("up > 1 OR (up = 1 AND least = 0)").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """Per class in links (a, b): cls and comp, the least class that can be reached.

    Large-star and small-star steps: the neighbours of each node move to its least
    neighbour, until every edge leads to the least node of its component. Each step sums
    per node before it shuffles.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    while True:
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))  # read once
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        if _settled(edges):
            break
    roots = edges.select(F.col("v").alias("cls"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("cls"), F.col("v").alias("comp")).union(roots)


def _cells(members: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, dealt into cells of bounded size in which they are to be compared.

    The component of a bucket's centre is its main one. Its members are compared with the
    others, and the others among each other; the centre itself has been compared with all.
    """
    rows = members.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    rows = rows.join(reps.select("cls", "n_shingles"), "cls")
    centre = rows.groupBy("band", "key").agg(F.max(F.struct("degree", "cls", "comp")).alias("centre"))
    rows = rows.join(centre, ["band", "key"]).withColumn("main", F.col("comp") == F.col("centre.comp"))
    total = lambda main, of: F.sum(F.when(F.col("main") == main, of).otherwise(0))
    counts = rows.groupBy("band", "key").agg(
        total(True, F.lit(1)).alias("n_main"),
        total(False, F.lit(1)).alias("n_other"),
        total(True, F.col("n_shingles")).alias("s_main"),
        total(False, F.col("n_shingles")).alias("s_other"),
    )
    counts = counts.where("n_other > 0 AND n_main + n_other > 2")
    rows = rows.where(F.col("cls") != F.col("centre.cls")).join(counts, ["band", "key"])
    blocks = lambda n, s: F.greatest(F.ceil(n / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    n_main = F.when(F.col("n_main") > 1, blocks(F.col("n_main") - 1, F.col("s_main"))).otherwise(0)
    n_other = blocks(F.col("n_other"), F.col("s_other"))
    block = F.pmod(F.xxhash64("cls"), F.when(F.col("main"), n_main).otherwise(n_other)).cast("int")
    rows = rows.select(
        "band", "key", "cls", "comp", "main", F.col("n_other").alias("others"), n_main.alias("n_main"), n_other.alias("n_other"), block.alias("block")
    )
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.col("block")
    cross = F.when(F.col("main"), F.transform(upto(F.col("n_other")), lambda j: cell(0, own, j)))
    cross = cross.otherwise(F.transform(upto(F.col("n_main")), lambda i: cell(0, i, own)))
    among = F.transform(upto(F.col("n_other")), lambda j: cell(1, F.least(own, j), F.greatest(own, j)))
    alone = F.col("main") | (F.col("others") < 2)
    among = F.when(alone, F.array().cast("array<struct<kind:int,i:int,j:int>>")).otherwise(among)
    rows = rows.withColumn("cell", F.explode(F.concat(cross, among)))
    return rows.select("band", "key", "cell", "cls", "comp", "main", "block")


def links_in_cells(cells: DataFrame, docs: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between classes of different components, of which enough to connect what is linked within a cell.

    A pair is looked at in the first band it shares. Its signatures are compared first, and
    if they may belong to a link, its whole sets, the likeliest pairs first; a pair that a
    chain of links within the cell has connected by then is passed over.
    """
    sets = sets_of(cells.select("cls"), docs, reps, rule).join(reps.select("cls", "sig", "keys"), "cls")
    cells = cells.join(sets, "cls")

    def work(table: pa.Table) -> pa.Table:
        rows = table.num_rows
        empty = pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
        if rows < 2:
            return empty
        cell = table.column("cell")[0].as_py()
        band = table.column("band")[0].as_py()
        names = table.column("cls").to_pylist()
        sig = _matrix(table.column("sig").combine_chunks())
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(rows, -1)
        flat = table.column("shingles").combine_chunks()
        edges = flat.offsets.to_numpy()
        shingles = flat.values.to_numpy(zero_copy_only=False).view(np.uint64)
        size = np.diff(edges)
        index: dict[bytes, int] = {}
        comp = np.array([index.setdefault(c, len(index)) for c in table.column("comp").to_pylist()])
        main, block = np.array(table.column("main").to_pylist()), table.column("block").to_numpy()
        if cell["kind"] == 0:
            left, right = np.flatnonzero(main), np.flatnonzero(~main)
            x, y = np.repeat(left, len(right)), np.tile(right, len(left))
        elif cell["i"] == cell["j"]:
            x, y = np.triu_indices(rows, 1)
        else:
            left, right = np.flatnonzero(block == cell["i"]), np.flatnonzero(block == cell["j"])
            x, y = np.repeat(left, len(right)), np.tile(right, len(left))
        apart = comp[x] != comp[y]
        x, y = x[apart], y[apart]
        if not len(x):
            return empty
        kept = []
        for at in range(0, len(x), CHUNK):
            i, j = x[at : at + CHUNK], y[at : at + CHUNK]
            alive, n = likely(sig[i], sig[j], (size[i], size[j]), rule)
            i, j = i[alive], j[alive]
            first = ~(keys[i, :band] == keys[j, :band]).any(axis=1)
            kept.append((i[first], j[first], n[first]))
        x, y, matches = (np.concatenate(parts) for parts in zip(*kept, strict=True))
        order = np.argsort(-matches, kind="stable")
        leader = list(range(len(index)))

        def lead(c: int) -> int:
            while leader[c] != c:
                leader[c] = c = leader[leader[c]]
            return c

        found = []
        for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
            p, q = lead(comp[i]), lead(comp[j])
            if p == q:
                continue
            one, two = shingles[edges[i] : edges[i + 1]], shingles[edges[j] : edges[j + 1]]
            at = np.searchsorted(two, one)
            both = int((two[np.minimum(at, len(two) - 1)] == one).sum())
            if 100 * both >= rule.percent * (len(one) + len(two) - both):
                leader[p] = q
                found.append((min(names[i], names[j]), max(names[i], names[j])))
        return pa.table({"a": pa.array([p[0] for p in found], pa.binary()), "b": pa.array([p[1] for p in found], pa.binary())})

    return cut(cells.groupBy("band", "key", "cell").applyInArrow(work, "a binary, b binary").distinct())


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id and kept.

    Words are runs without ASCII white space, with A-Z lower-cased; a document's set holds
    its distinct shingles, or with fewer words all of them as one. Documents are linked if
    their sets' similarity is rule.percent or more; component_id is the smallest doc_id
    that can be reached over links, and kept is set for that document itself.

    A null or empty text has no shingles and is its own component. Rows with a null
    doc_id are linked with nothing: component_id null, kept true. Rows that repeat a
    doc_id are told apart by their texts; full copies of a kept row are all kept. Of equal
    sets only one is compared with others, so that copies cost nothing but their reading.
    Exact but for the two chances of rule: a pair at the threshold that shares no band, and
    one whose posterior falls below rule.prune.
    """
    docs = pick(docs, doc_id=doc_id, text=text)
    base = cut(describe(docs, rule))
    named = base.where("cls IS NOT NULL").groupBy("cls")
    reps = cut(named.agg(F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("n_shingles", "sig", "keys")]))
    rows = reps.select("cls", F.posexplode("keys").alias("band", "key"))
    crowded = rows.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(crowded, ["band", "key"])
    degree = rows.groupBy("cls").agg(F.sum("n").alias("degree"))
    members = cut(rows.select("band", "key", "cls").join(degree, "cls"))
    centre = members.groupBy("band", "key").agg(F.max(F.struct("degree", "cls")).alias("centre"))
    star = members.join(centre, ["band", "key"]).where(F.col("cls") != F.col("centre.cls"))
    star = star.select(F.least("cls", "centre.cls").alias("a"), F.greatest("cls", "centre.cls").alias("b")).distinct()
    links = verify(cut(prune_pairs(star, reps, rule)), docs, reps, rule)
    labels = components(links)
    more = links_in_cells(cut(_cells(members, labels, reps)), docs, reps, rule)
    if not more.isEmpty():
        labels = components(links.union(more))
    named = reps.select("cls", "least").join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    smallest = named.groupBy("comp").agg(F.min("least").alias("smallest"))
    named = named.join(smallest, "comp").select("cls", "smallest")
    out = base.select("doc_id", "n_shingles", "cls").join(named, "cls", "left")
    component = F.coalesce("smallest", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
