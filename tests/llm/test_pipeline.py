"""The pipeline and the registered queries of the subpackage."""

import itertools
import random
import re

import corpus_pipeline
from tablekeel.llm.queries import QUERIES
from tests.llm.helpers import DOCS, ODD, docs

FOLDER = "/root/testdata/sf0.001"


def test_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes = [frame.count()]
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, FOLDER).cache()
        sizes.append(frame.count())
        if name != "packing":
            assert frame.columns == corpus_pipeline.COLUMNS
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3] > 0 and sizes[4] == sizes[5]
    assert frame.where("padded < n_tokens OR batch IS NULL").count() == 0


def test_stages_on_awkward_rows(spark):
    for rows in (ODD, []):
        frame = docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, FOLDER)
        frame.collect()
    once = corpus_pipeline.drop_near_duplicates(spark, docs(spark), FOLDER).collect()
    assert sorted((r.doc_id for r in once if r.doc_id is not None)) == [-3, 1, 2, 3, 4, 5, 6, 7, 9]


def similar(a, b):
    sets = []
    for text in (a, b):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1]) > 0


def test_near_duplicates_are_decided_by_row(spark):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(30)]
    rows = []
    for k, text in enumerate(base):
        near = text.rsplit(" ", 1)[0] + " other"
        rows += [(rng.choice([None, k, rng.randrange(30)]), t) for t in (text, text, near)[: rng.randint(1, 3)]]
    # A text that shares its id with a copy of another, two copies without an id, and texts without words.
    rows += [(40, "a b c d e f g h"), (41, "a b c d e f g h"), (41, "one clean text of its own"), (None, "x y z"), (None, "x y z"), (42, None), (42, ""), (None, None)]
    frame = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, frame, FOLDER).collect()]
    leader = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if similar(rows[i][1], rows[j][1]):
            low, high = sorted((leader[i], leader[j]))
            leader = [low if x == high else x for x in leader]
    groups = {}
    for row, group in zip(rows, leader, strict=True):
        groups.setdefault(group, []).append(row)
    assert len(got) == len(groups)
    for members in groups.values():
        least = min((i for i, _ in members if i is not None), default=None)
        assert sum(got.count(row) > 0 and row[0] == least for row in set(members)) >= 1
    again = corpus_pipeline.drop_near_duplicates(spark, frame.repartition(3), FOLDER).collect()
    assert sorted(map(repr, got)) == sorted(repr((r.doc_id, r.text)) for r in again)


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
