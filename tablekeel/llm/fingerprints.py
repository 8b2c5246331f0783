"""Document fingerprints by invertible Bloom lookup sketches.

A document is the set of its paragraphs' digests. Its sketch adds each digest to one cell
of each of three tables: a count, and the exclusive-or of digests and of their checks. Two
sketches subtract cell by cell, which leaves the digests that only one version has. A cell
that holds one digest gives it away; taking it out of its other cells frees further ones,
until nothing is left. If that gets stuck, it is tried again with larger sketches of shares
of the digests, and where a share stays stuck, with larger ones of that share.
Everything is a DataFrame expression, and works within a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekeel.llm.common import pick, small

#: Cells of each of the three tables: of the fingerprint itself, and of a share of a larger sketch.
BASE_CELLS, SHARE_CELLS = 5, 12
#: A larger sketch divides the digests into shares of about so many of both versions, with a sketch each, so that its
#: work grows with the digests. A share that gets stuck is tried again with more cells, so many times as many in turn.
SHARE_DIGESTS, LARGER = 32, (1, 2, 4, 8)
ROUNDS = 16
#: A paragraph is a line; a longer line is cut into paragraphs of so many characters.
PARAGRAPH = 256
#: Ids that lie next to each other in one range, and ranges in a range of ranges.
RANGE, RANGES = 256, 1 << 16


# The functions below write SQL expressions as text. Arguments are SQL, but for numbers of cells.


def let(name: str, value: str, use: str) -> str:
    """use, with name standing for the value, which is evaluated once however often it is used, in lambdas too."""
    return f"transform(array({value}), {name} -> {use})[0]"


def paragraph_digests(text: str) -> str:
    """Distinct 64-bit digests of the paragraphs of a text; empty for an empty one."""
    return f"array_distinct(transform(regexp_extract_all({text}, '[^\\\\n]{{1,{PARAGRAPH}}}', 0), p -> xxhash64(p)))"


def _entry(key: str, cells: int, more: str = "") -> str:
    """A digest with its check and its cell in each of the three tables, from bits of its own for each."""
    places = [f"'p{t}', CAST(pmod(shiftrightunsigned({key}, {13 * t}), {cells}) AS INT)" for t in range(3)]
    return f"named_struct('k', {key}, 'c', xxhash64({key}, 7), {', '.join(places)}{more})"


def _cell(n: str, k: str, c: str) -> str:
    return f"named_struct('n', CAST({n} AS INT), 'k', {k}, 'c', {c})"


def sketch(digests: str, cells: int) -> str:
    """The cells of all three tables, one after another."""
    add = _cell("x.n + 1", "x.k ^ y.k", "x.c ^ y.c")
    entries = f"transform({digests}, d -> {_entry('d', cells)})"
    tables = []
    for t in range(3):
        fill = f"aggregate(filter(es, e -> e.p{t} = i), {_cell('0', '0L', '0L')}, (x, y) -> {add})"
        tables.append(f"transform(sequence(0, {cells - 1}), i -> {fill})")
    return let("es", entries, f"concat({', '.join(tables)})")


def subtract(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> {_cell('x.n - y.n', 'x.k ^ y.k', 'x.c ^ y.c')})"


def peel(difference: str, cells: int) -> str:
    """How many digests only one version has, found by taking them out one after another, or null if that gets stuck."""
    start = f"named_struct('cells', {difference}, 'found', 0L, 'going', true)"
    pure = "filter(s.cells, c -> abs(c.n) = 1 AND c.c = xxhash64(c.k, 7))"
    more = ", 'n', c.n"
    pure = f"array_distinct(transform({pure}, c -> {_entry('c.k', cells, more)}))"
    tables = []
    for t in range(3):
        without = _cell("x.n - y.n", "x.k ^ y.k", "x.c ^ y.c")
        without = f"aggregate(filter(pure, e -> e.p{t} = i), cell, (x, y) -> {without})"
        tables.append(f"transform(slice(s.cells, {t * cells + 1}, {cells}), (cell, i) -> {without})")
    left = f"CASE WHEN size(pure) > 0 THEN concat({', '.join(tables)}) ELSE s.cells END"
    turn = let("pure", pure, f"named_struct('cells', {left}, 'found', s.found + size(pure), 'going', size(pure) > 0)")
    end = f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> CASE WHEN s.going THEN {turn} ELSE s END)"
    return let("z", end, "CASE WHEN forall(z.cells, c -> c.n = 0 AND c.k = 0 AND c.c = 0) THEN z.found END")


def share_difference(share: str) -> str:
    """How many digests only one version has, of a share: by sketches, larger ones if they get stuck, or else one by one."""
    a, b = (f"transform(filter({share}, e -> e.side = {side}), e -> e.d)" for side in (0, 1))
    tries = [peel(subtract(sketch("one", SHARE_CELLS * n), sketch("two", SHARE_CELLS * n)), SHARE_CELLS * n) for n in LARGER]
    apart = "CAST(size(array_except(one, two)) + size(array_except(two, one)) AS BIGINT)"
    return let("one", a, let("two", b, f"coalesce({', '.join(tries)}, {apart})"))


def difference_size(a: str, b: str, base_a: str, base_b: str) -> str:
    """How many digests only one of two versions has: by the fingerprints, or where these get stuck by larger sketches.

    The digests of both are sorted by share, so that each is looked at once: starts are the
    places where another share begins.
    """
    first = peel(subtract(base_a, base_b), BASE_CELLS)
    shares = f"CAST(ceil((size({a}) + size({b})) / {SHARE_DIGESTS}) AS BIGINT)"
    tagged = [
        f"transform({x}, d -> named_struct('share', pmod(shiftrightunsigned(d, 40), shares), 'd', d, 'side', {side}))"
        for side, x in enumerate((a, b))
    ]
    starts = "filter(sequence(1, size(sorted)), j -> j = 1 OR sorted[j - 1].share <> sorted[j - 2].share)"
    of = "slice(sorted, p, coalesce(get(starts, k + 1), size(sorted) + 1) - p)"
    total = f"aggregate(transform(starts, (p, k) -> {let('members', of, share_difference('members'))}), 0L, (sum, n) -> sum + n)"
    larger = let("shares", shares, let("sorted", f"array_sort(concat({tagged[0]}, {tagged[1]}))", let("starts", starts, total)))
    return f"coalesce({first}, {larger})"


def likeness(a: str, b: str, base_a: str, base_b: str) -> str:
    """1 less the share of digests, of both versions together, that only one has; 1.0 if both have none."""
    both = f"(size({a}) + size({b}))"
    return f"CASE WHEN {both} = 0 THEN 1.0D ELSE 1 - {difference_size(a, b, base_a, base_b)} / {both} END"


def as_text(cells: str) -> str:
    """A sketch as hexadecimal digits: 4 for a count, modulo 65,536, and 16 for each exclusive-or."""
    one = "lpad(hex(c.n & 65535), 4, '0') || lpad(hex(c.k), 16, '0') || lpad(hex(c.c), 16, '0')"
    return f"lower(array_join(transform({cells}, c -> {one}), ''))"


def next_firsts(ranges: DataFrame) -> DataFrame:
    """For each range its number and the first id of the next range there is; after the last comes the first.

    ranges: range and first. Ranges of ranges are ordered among each other, and ranges
    within them, so that one task sees no more than one in RANGES of them.
    """
    ranges = ranges.withColumn("outer", F.expr(f"floor(range / {RANGES})"))
    heads = ranges.groupBy("outer").agg(F.min("first").alias("head"))
    everywhere = Window.partitionBy(F.lit(0)).orderBy("outer")
    follow = F.coalesce(F.lead("head").over(everywhere), F.first("head").over(everywhere))
    heads = heads.select("outer", follow.alias("follow"))
    inside = Window.partitionBy("outer").orderBy("range")
    ranges = ranges.withColumn("next", F.lead("first").over(inside)).join(heads, "outer")
    return ranges.select("range", F.coalesce("next", "follow").alias("next"))


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, digests) with next_text and next_digests of the row with the next larger doc_id.

    Rows are shuffled once, by ranges of ids; the first row of each range also goes to the
    range before it. The row with the largest id is followed by the first. Rows with the
    same id follow each other in order of their texts. A null id has no next row.
    """
    number = F.expr(f"floor(doc_id / {RANGE})")
    ranges = docs.where("doc_id IS NOT NULL").groupBy(number.alias("range")).agg(F.min("doc_id").alias("first"))
    guests = next_firsts(ranges).select(F.col("next").alias("doc_id"), F.col("range").alias("guest_of"))
    place = lambda guest, of: F.struct(F.lit(guest).alias("guest"), of.cast("long").alias("range"))
    rows = docs.where("doc_id IS NOT NULL").join(small(guests), "doc_id", "left")
    both = F.array(place(0, number), place(1, F.col("guest_of")))
    rows = rows.select("doc_id", "text", "digests", F.explode(F.filter(both, lambda p: p["range"].isNotNull())).alias("place"))
    # Plain columns, and both leads at once: Spark then sees one window, and shuffles the texts once.
    rows = rows.select("doc_id", "text", "digests", F.col("place.guest").alias("guest"), F.col("place.range").alias("range"))
    order = Window.partitionBy("range").orderBy("guest", "doc_id", "text")
    leads = [F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "digests")]
    rows = rows.select("doc_id", "text", "digests", *leads, "guest").where("guest = 0").drop("guest")
    without = docs.where("doc_id IS NULL").select("doc_id", "text", "digests")
    nothing = [F.lit(None).cast("string").alias("next_text"), F.lit(None).cast("array<bigint>").alias("next_digests")]
    return rows.unionByName(without.select("*", *nothing))


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs, with its fingerprint and that of an edited text.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_paragraphs. In the edited text the second half gives way to as much of the head of
    the next document's text (see with_next; nothing for a null doc_id). A null text is
    empty: no paragraphs, and likeness 1.0 to another empty one and 0.0 to all others.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("digests", F.expr(paragraph_digests("text"))))
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), chars - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)
    )
    rows = rows.select("doc_id", chars.cast("long").alias("n_chars"), "digests", "next_digests", edited.alias("edited"))
    digests = f"""named_struct('own', digests, 'next', coalesce(next_digests, CAST(array() AS ARRAY<BIGINT>)),
        'edited', {paragraph_digests("edited")})"""
    sketches = ", ".join(f"'{name}', {sketch(f'd.{name}', BASE_CELLS)}" for name in ("own", "next", "edited"))
    result = f"""named_struct(
        'fingerprint', {as_text("b.own")},
        'edited_fingerprint', {as_text("b.edited")},
        'near_edited', {likeness("d.own", "d.edited", "b.own", "b.edited")},
        'near_next', {likeness("d.own", "d.next", "b.own", "b.next")},
        'n_paragraphs', CAST(size(d.own) AS BIGINT))"""
    result = let("d", digests, let("b", f"named_struct({sketches})", result))
    # Exploding one element keeps the optimizer from computing the whole once more for each column.
    out = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.expr(f"explode(array({result}))").alias("f"))
    return out.select("doc_id", "n_chars", "edited_sha256", "f.*")
