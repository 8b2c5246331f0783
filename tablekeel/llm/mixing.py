"""Mixing overlapping sources to target weights by a min-cost flow.

Documents that belong to the same set of sources are alike to the mix, so they are summed
up to one node: a membership pattern with so many words. Words flow from each source's
quota to the patterns that belong to it, and leave a pattern through one arc for each time
its documents may be repeated, each as wide as the pattern has words and dearer than the
one before. The cheapest full flow says how often each pattern is used; seeded hashes
then choose its documents.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekeel.llm.common import WORD, cut, pick, small

#: More sources or patterns than this are refused: their sums, a row each, are held by the driver.
MOST_PATTERNS = 100_000
#: Levels of 256 buckets by which the place of a document in its pattern's seeded order is found.
_LEVEL = 256


class Flow:
    """Maximum flows from 0 to 1 by blocking flows; capacities may be raised between runs."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.left: list[int] = []

    def arc(self, a: int, b: int, capacity: int) -> int:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.left += [capacity, 0]
        return len(self.to) - 2

    def run(self) -> int:
        total = 0
        while (level := self._levels())[1] >= 0:
            at = [0] * len(self.out)
            while pushed := self._push(level, at):
                total += pushed
        return total

    def _levels(self) -> list[int]:
        level = [-1] * len(self.out)
        level[0] = 0
        queue = deque([0])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.left[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def _push(self, level: list[int], at: list[int]) -> int:
        path: list[int] = []
        a = 0
        while a != 1:
            while at[a] < len(self.out[a]):
                e = self.out[a][at[a]]
                if self.left[e] and level[self.to[e]] == level[a] + 1:
                    break
                at[a] += 1
            else:
                if not path:
                    return 0
                a = self.to[path.pop() ^ 1]
                at[a] += 1
                continue
            path.append(e)
            a = self.to[e]
        width = min(self.left[e] for e in path)
        for e in path:
            self.left[e] -= width
            self.left[e ^ 1] += width
        return width


def route(
    quotas: list[int], patterns: list[list[int]], words: list[int], most_repeats: int
) -> tuple[list[int], dict[tuple[int, int], int]]:
    """How many words of each pattern to use, and the flow from each source to each pattern.

    patterns: the sources of each. The cost of a pattern's words grows with each time they
    are repeated and is nil on the way to it, so that the cheapest flow is found by filling
    all first uses as far as they go, then allowing second uses, and so on.
    """
    flow = Flow(2 + len(quotas) + len(patterns))
    for s, quota in enumerate(quotas):
        flow.arc(0, 2 + s, quota)
    between = {}
    for p, members in enumerate(patterns):
        for s in members:
            between[s, p] = flow.arc(2 + s, 2 + len(quotas) + p, sum(quotas) + 1)
    leave = [flow.arc(2 + len(quotas) + p, 1, 0) for p in range(len(patterns))]
    left = sum(quotas)
    for _ in range(most_repeats):
        if left <= 0:
            break
        for e, n in zip(leave, words, strict=True):
            flow.left[e] += n
        left -= flow.run()
    return [flow.left[e ^ 1] for e in leave], {k: flow.left[e ^ 1] for k, e in between.items() if flow.left[e ^ 1]}


def share_out(sizes: list[int], weights: list[Fraction], total: int, most_repeats: int) -> list[Fraction]:
    """Targets in proportion to the weights, none above most_repeats times its size; the excess goes to the others."""
    targets = [Fraction(0)] * len(sizes)
    open_, left = [i for i, w in enumerate(weights) if w > 0], Fraction(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most_repeats * sizes[i]]
        for i in full:
            targets[i] = Fraction(most_repeats * sizes[i])
            left -= targets[i]
        if not full:
            for i in open_:
                targets[i] = weights[i] * unit
            break
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def whole(targets: list[Fraction]) -> list[int]:
    """Rounded down, with the largest remainders rounded up so that the sum stays."""
    low = [int(t) for t in targets]
    rest = round(sum(targets)) - sum(low)
    for i in sorted(range(len(targets)), key=lambda i: (low[i] - targets[i], i))[: max(0, rest)]:
        low[i] += 1
    return low


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | list[float],
    *,
    seed: int = 0,
    most_repeats: int = 3,
    doc_id: str = "doc_id",
    size: str = "size",
    sources: str = "sources",
    total: int | None = None,
) -> Mix:
    """How often to take each document, and what each source gets.

    docs: doc_id, size (words; null or negative: 0) and sources, an array of the sources a
    document belongs to (nulls in it are a source of their own; null or empty: the same as
    one null). weights: by source, or a list that repeats over the sources in order of
    code points, null last; a source without a weight has 0. total: words to share out, by
    default all sizes together; a document of two sources counts once there, and in the
    size of both.

    The first result has doc_id, size, sources, repeats and taken (repeats * size). repeats
    is the same for all documents of a pattern but for one more on a seeded part of them:
    what its words fall short of those routed by is less than any other of its documents has.
    Documents without words have 0. Ids may repeat or be null: rows of equal id and size share
    their fate and count as one document. The second result
    has source, source_size, target (double) and routed (long).

    Patterns and sources are summed by Spark; the driver routes between at most
    MOST_PATTERNS of them, and refuses more. docs is read once and kept, without texts,
    in the shared folder. Reruns agree: order comes from hashes of seed, id and size.
    """
    spark = docs.sparkSession
    rows = cut(_placed(pick(docs, doc_id=doc_id, size=size, sources=sources), seed).drop("doc_id"))
    found = rows.groupBy("sources").agg(F.sum("size").alias("words")).take(MOST_PATTERNS + 1)
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    order = lambda s: (s is None, s or "")
    found.sort(key=lambda r: [order(s) for s in r.sources])
    names = sorted({s for r in found for s in r.sources}, key=order)
    index = {s: i for i, s in enumerate(names)}
    members = [[index[s] for s in r.sources] for r in found]
    words = [r.words for r in found]
    sizes = [0] * len(names)
    for m, n in zip(members, words, strict=True):
        for i in m:
            sizes[i] += n
    if isinstance(weights, dict):
        by_source = [Fraction(weights.get(s, 0)) for s in names]
    else:
        by_source = [Fraction(weights[i % len(weights)]) for i in range(len(names))]
    targets = share_out(sizes, by_source, sum(words) if total is None else total, most_repeats)
    used, flows = route(whole(targets), members, words, most_repeats)
    routed = [0] * len(names)
    for (s, _), n in flows.items():
        routed[s] += n
    plan = spark.createDataFrame(
        [(i, r.sources, u // w if w else 0, u % w if w else 0) for i, (r, u, w) in enumerate(zip(found, used, words, strict=True))],
        "pattern int, sources array<string>, times long, rest long",
    )
    summary = spark.createDataFrame(
        [(s, sizes[i], float(targets[i]), routed[i]) for i, s in enumerate(names)],
        "source string, source_size long, target double, routed long",
    )
    return Mix(seed, plan, *_ends(rows.join(F.broadcast(plan), "sources")), summary)


def _placed(rows: DataFrame, seed: int) -> DataFrame:
    """Rows of doc_id, size and sources, tidied, with each document's place in the seeded order of its pattern."""
    sources = F.when(F.size(F.coalesce("sources", F.array())) > 0, F.array_sort(F.array_distinct("sources")))
    rows = rows.withColumn("size", F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(0)), F.lit(0)).cast("long"))
    rows = rows.withColumn("sources", sources.otherwise(F.array(F.lit(None).cast("string"))))
    return rows.withColumn("place", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size")), 1))


@dataclass
class Mix:
    """A plan that says of any document how often it is taken, by its pattern and its place in the seeded order.

    summary has source, source_size, target (double) and routed (long); plan and ends have
    a row per pattern. together has places that are taken, or not, whatever the runs of ends say.
    """

    seed: int
    plan: DataFrame
    ends: DataFrame
    together: DataFrame
    summary: DataFrame

    def repeats(self, docs: DataFrame) -> DataFrame:
        """docs (doc_id, size, sources and others) with repeats; plan and ends are bounded, so that only many rows in together take a shuffle."""
        rows = _placed(docs, self.seed).join(F.broadcast(self.plan), "sources").join(F.broadcast(self.ends), "pattern", "left")
        if not self.together.isEmpty():
            rows = rows.join(small(self.together), ["pattern", "place"], "left")
        else:
            rows = rows.withColumn("fate", F.lit(None).cast("boolean"))
        more = F.coalesce(F.col("fate"), _taken("size"), F.lit(False)).cast("long")
        rows = rows.withColumn("repeats", F.when(F.col("size") > 0, F.col("times") + more).otherwise(0).cast("long"))
        return rows.select(*docs.columns, "repeats")


def _ends(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per pattern which documents are taken once more, as runs of its seeded order, and the places whose fate is another.

    In the seeded order, places are taken up to the first that does not fit in what those
    before it have left of the pattern's rest. What is left then, less than that one place
    holds, is filled from the places after it, the largest first and equal ones in the
    seeded order, until none fits. A run has begin, end, least and most: its places lie above
    begin and up to end, and their documents have so many words. Filling a rest halves it
    with each run but those of whole ranges of sizes between them, so that a pattern has
    at most some dozens of runs, however many documents it has.

    The second result has the pattern, place and fate of documents that share their place,
    where the size of one says otherwise than the words of all. rows has a document's size
    and place, and its pattern's number and rest.
    """
    open_ = rows.where((F.col("rest") > 0) & (F.col("size") > 0))
    alike = open_.groupBy("pattern", "place").agg(F.sum("size").alias("words"), F.min("size").alias("size"), F.first("rest").alias("left"))
    alike = cut(alike)
    fitting = alike.where("words <= left")
    first = cut(_run(fitting))
    begun = F.struct(F.lit(-1).cast("long").alias("begin"), "end", F.lit(1).cast("long").alias("least"), F.col("left").alias("most"))
    lefts = alike.groupBy("pattern").agg(F.first("left").alias("left"))
    runs = first.join(lefts, "pattern").select("pattern", begun.alias("run"))

    beyond = fitting.join(F.broadcast(first.select("pattern", "end", "rest")), "pattern").where("place > end AND words <= rest")
    sizes = beyond.groupBy("pattern", "words").agg(F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("end").alias("end"))
    fills = cut(sizes.groupBy("pattern").applyInPandas(_fill, "pattern int, end long, least long, most long, take long"))
    some = _places(beyond, fills.where("take > 0").select("pattern", F.col("least").alias("words"), "take"))
    upto = F.coalesce("upto", F.when(F.col("take") == 0, F.lit((1 << 63) - 1)))
    fills = fills.join(small(some.withColumnRenamed("words", "least")), ["pattern", "least"], "left")
    fill = F.struct(F.col("end").alias("begin"), upto.alias("end"), "least", "most")
    runs = cut(runs.unionByName(fills.select("pattern", fill.alias("run"))).groupBy("pattern").agg(F.collect_list("run").alias("runs")))
    together = alike.where("words > size").join(F.broadcast(runs), "pattern")
    together = together.withColumn("fate", _taken("words")).where(F.col("fate") != _taken("size")).select("pattern", "place", "fate")
    return runs, cut(together)


def _taken(size: str) -> Column:
    """Whether a place of so many words lies in one of the runs."""
    place, words = F.col("place"), F.col(size)
    return F.exists("runs", lambda r: (place > r["begin"]) & (place <= r["end"]) & (words >= r["least"]) & (words <= r["most"]))


def _fill(sizes: pd.DataFrame) -> pd.DataFrame:
    """Which sizes fill a pattern's rest, the largest first: ranges of which all are taken (take 0), or so many of one size.

    sizes has a row for each size there is, with its number of places (n), so that it is as
    long as there are different sizes, not documents.
    """
    sizes = sizes.sort_values("words", ascending=False)
    left, out = int(sizes["rest"].iloc[0]), []
    whole: list[int] = []
    for words, n in zip(sizes["words"].tolist(), sizes["n"].tolist(), strict=True):
        take = min(n, left // words)
        left -= take * words
        if take == n:
            whole = [words, whole[1] if whole else words]
            continue
        if whole:
            out.append((*whole, 0))
            whole = []
        if take:
            out.append((words, words, take))
    if whole:
        out.append((*whole, 0))
    found = pd.DataFrame(out, columns=["least", "most", "take"], dtype="int64")
    found.insert(0, "pattern", sizes["pattern"].iloc[0])
    found.insert(1, "end", sizes["end"].iloc[0])
    return found


def _places(places: DataFrame, wanted: DataFrame) -> DataFrame:
    """pattern, words and upto: the place up to which the wanted number (take) of places of that size lie.

    It is looked for in ranges of places first, so that no task sorts all places of a size.
    """
    wanted = small(cut(wanted))
    places = places.select("pattern", "words", "place").join(wanted, ["pattern", "words"])
    places = places.withColumn("range", F.shiftright("place", 47))
    by = ["pattern", "words"]
    counts = places.groupBy(*by, "take", "range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = counts.withColumn("before", before).where("before < take AND take <= before + n").select(*by, "range", "before")
    inside = places.join(small(cut(reached)), [*by, "range"])
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("place"))
    return inside.withColumn("rank", rank).where("before + rank = take").select(*by, F.col("place").alias("upto"))


def _run(fitting: DataFrame) -> DataFrame:
    """Per pattern the last place that is taken before one that does not fit (end), what is left then (rest), and the last place there is.

    The run ends where the words so far pass what is left, or else at the last place. That is
    found level by level: sums of 256 ranges of the hashes, then of 256 within the range
    where it is passed, then of the single hashes there, so that no task ever sorts a whole
    pattern. fitting has pattern, left, place and words, none above left.
    """
    high, low = F.shiftright("place", 55).cast("int"), F.shiftright("place", 47).bitwiseAND(_LEVEL - 1).cast("int")
    fitting = fitting.withColumn("high", high).withColumn("low", low)
    sums = cut(fitting.groupBy("pattern", "left", "high", "low").agg(F.sum("words").alias("words"), F.max("place").alias("last")))
    every = sums.groupBy("pattern").agg(F.max("left").alias("left"), F.sum("words").alias("words"), F.max("last").alias("last"))

    def passed(level: DataFrame, by: str, kept: list[str]) -> DataFrame:
        """The one range of each pattern in which what is left is passed, and the words before it."""
        so_far = Window.partitionBy("pattern").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(so_far), F.lit(0)))
        level = level.where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words")))
        return level.select("pattern", *kept, "before")

    first = sums.groupBy("pattern", "left", "high").agg(F.sum("words").alias("words"))
    first = passed(first.withColumn("before", F.lit(0).cast("long")), "high", ["high"])
    second = passed(sums.join(F.broadcast(first), ["pattern", "high"]), "low", ["high", "low"])
    last = fitting.join(F.broadcast(second), ["pattern", "high", "low"])
    so_far = Window.partitionBy("pattern").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    after = F.col("before") + F.coalesce(F.sum("words").over(so_far), F.lit(0)) + F.col("words")
    begin = F.shiftleft(F.col("high").cast("long"), 55) + F.shiftleft(F.col("low").cast("long"), 47)
    fits = after <= F.col("left")
    ends = last.select(
        "pattern",
        F.when(fits, F.col("place")).otherwise(begin - 1).alias("end"),
        F.when(fits, F.col("left") - after).otherwise(F.col("left") - F.col("before")).alias("rest"),
    )
    ends = ends.groupBy("pattern").agg(F.max("end").alias("end"), F.min("rest").alias("rest"))
    whole = every.where("words <= left").select("pattern", F.col("last").alias("end"), (F.col("left") - F.col("words")).alias("rest"), "last")
    return ends.join(F.broadcast(every.select("pattern", "last")), "pattern").unionByName(whole)


def mix_by_source(
    docs: DataFrame,
    weights: list[float],
    *,
    seed: int = 0,
    most_repeats: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """doc_id, size (words of the text), source, source_size, target, taken and repeats, for documents of one source each.

    A null text has no words and a null source is a source of its own, ordered last.
    """
    rows = pick(docs, doc_id=doc_id, text=text, source=source)
    rows = cut(rows.select("doc_id", words_in(F.col("text")).alias("size"), F.array("source").alias("sources")))  # texts are read once
    plan = mix(rows, weights, seed=seed, most_repeats=most_repeats)
    taken = plan.repeats(rows).withColumn("source", F.col("sources")[0])
    summary = plan.summary.withColumnRenamed("source", "_source")
    taken = taken.join(F.broadcast(summary), F.col("source").eqNullSafe(F.col("_source")), "left")
    words = (F.col("repeats") * F.col("size")).alias("taken")
    return taken.select("doc_id", "size", "source", "source_size", "target", words, "repeats")
