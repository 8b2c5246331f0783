"""Packing into batches by optimal length buckets.

Documents of a batch are padded to the length of their bucket. The number of documents of
each length is counted over all data; dynamic programming over that histogram finds the
bucket ends with the least padding. Within each bucket documents are put in a seeded order
and cut into batches whose padded tokens keep within a budget.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekeel.llm.common import cut, pick

#: Lengths up to here are told apart; longer ones are rounded up by less than 1/256, so that
#: the histogram has 32,768 entries and 128 for each further doubling of the length, whatever the data.
EXACT_LENGTHS = 1 << 15
#: Documents, on average, of one sorted part of a bucket.
PART_ROWS = 1024


def rounded(length: Column) -> Column:
    """The length, or beyond EXACT_LENGTHS the next multiple of 1/256 to 1/128 of it."""
    step = F.greatest(F.lit(0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))) - 7).cast("int")
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), step)
    up = F.floor((length + unit - 1) / unit).cast("long") * unit
    return F.when(length <= EXACT_LENGTHS, length).otherwise(up)


def bucket_ends(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Ends of at most so many buckets with the least padding in all; histogram: (length, documents), ascending.

    A bucket from after i up to j costs documents(i..j) * length(j) - tokens(i..j). For a
    given number of buckets the choice of i is a minimum over lines evaluated at growing
    lengths, which a queue of the lower hull gives in one pass.
    """
    lengths = [length for length, _ in histogram]
    docs, tokens = [0], [0]
    for length, n in histogram:
        docs.append(docs[-1] + n)
        tokens.append(tokens[-1] + n * length)
    size = len(lengths)
    best: list[int | None] = [0] + [None] * size
    back: list[list[int]] = []
    for _ in range(min(buckets, size)):
        now: list[int | None] = [None] * (size + 1)
        came = [0] * (size + 1)
        hull: deque[tuple[int, int, int]] = deque()  # (slope, offset, i), slopes falling
        for j in range(size + 1):
            if j and hull:
                x = lengths[j - 1]
                while len(hull) > 1 and hull[1][0] * x + hull[1][1] <= hull[0][0] * x + hull[0][1]:
                    hull.popleft()
                slope, offset, i = hull[0]
                now[j] = docs[j] * x - tokens[j] + slope * x + offset
                came[j] = i
            if best[j] is not None:
                line = (-docs[j], best[j] + tokens[j], j)
                while len(hull) > 1 and _needless(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
        back.append(came)
        best = now
        if best[size] == 0:
            break
    ends, j = [], size
    for came in reversed(back):
        if j == 0:
            break
        ends.append(lengths[j - 1])
        j = came[j]
    return ends[::-1]


def _needless(a: tuple[int, int, int], b: tuple[int, int, int], c: tuple[int, int, int]) -> bool:
    """Whether line b is nowhere below both a and c (slopes fall from a to c)."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(
    docs: DataFrame, *, buckets: int = 16, budget: int = 32_768, seed: int = 0, doc_id: str = "doc_id", length: str = "n_tokens"
) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, bucket, padded, batch and slot.

    bucket counts from 0 by length, padded is the length of its longest document, to which the
    others are padded; ends of buckets beyond EXACT_LENGTHS are the best for rounded lengths. batch
    counts from 0 within the bucket, and slot from 0 within the batch. A batch has as many
    documents as fit the budget of padded tokens, and one document if none fits. All
    batches of a bucket are full but the last. Rows with a null length or of 0 or less have
    nothing to pack: null in all four. Ids may be null or repeat. Reruns agree: order comes
    from a hash of seed, id and length, and only equal rows tie.
    """
    rows = pick(docs, doc_id=doc_id, n_tokens=length).withColumn("n_tokens", F.col("n_tokens").cast("long"))
    rows = cut(rows.withColumn("padded", F.when(F.col("n_tokens") > 0, rounded(F.col("n_tokens")))))
    histogram = rows.where("padded IS NOT NULL").groupBy("padded").agg(F.count("*").alias("n"), F.max("n_tokens").alias("longest")).collect()
    counts = sorted((r.padded, r.n) for r in histogram)
    longest = {r.padded: r.longest for r in histogram}
    ends = bucket_ends(counts, buckets)
    bucket, padded, parts = (F.lit(None).cast(t) for t in ("int", "long", "int"))
    for k, end in reversed(list(enumerate(ends))):
        inside = sum(n for x, n in counts if (k == 0 or x > ends[k - 1]) and x <= end)
        here = F.col("padded") <= end
        bucket = F.when(here, F.lit(k)).otherwise(bucket)
        parts = F.when(here, F.lit(-(-inside // PART_ROWS))).otherwise(parts)
        padded = F.when(here, F.lit(longest[end]).cast("long")).otherwise(padded)
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "n_tokens"), 1)
    placed = rows.where("padded IS NOT NULL").select(
        "doc_id", "n_tokens", bucket.alias("bucket"), padded.alias("padded"), parts.alias("parts"), place.alias("place")
    )
    placed = placed.withColumn("part", F.expr("place div CAST(ceil(9223372036854775807D / parts) AS BIGINT)"))
    # A document's rank: those in the parts before its own, and its row number within the part.
    sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    within = Window.partitionBy("bucket", "part").orderBy("place", "doc_id", "n_tokens")
    ranked = placed.withColumn("rank", F.row_number().over(within) - 1).join(sizes, ["bucket", "part"])
    rank = F.col("before") + F.col("rank")
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("padded"))).cast("long")
    packed = ranked.select(
        "doc_id", "n_tokens", "bucket", "padded", F.floor(rank / room).cast("long").alias("batch"), (rank % room).alias("slot")
    )
    nothing = rows.where("padded IS NULL").select(
        "doc_id", "n_tokens", *[F.lit(None).cast(t).alias(n) for n, t in (("bucket", "int"), ("padded", "long"), ("batch", "long"), ("slot", "long"))]
    )
    return packed.unionByName(nothing)
