"""Each operator against brute force, and on awkward rows and empty tables."""

import hashlib
import itertools
import random
import re
import time
import tracemalloc
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablekeel.llm import common, dedup, fingerprints, language, licenses, mixing, packing, quality, tokens, topk, warc
from tests.llm.helpers import DOCS, ODD, by_id, docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


# --- 1: mixing ---


def cheapest(quotas, patterns, sizes, most):
    """The most words that can flow, and the least cost at that, by trying all uses of the patterns."""
    best = (-1, 0)
    for uses in itertools.product(*[range(most * s + 1) for s in sizes]):
        total = sum(uses)
        # Hall's condition: any set of patterns is bounded by the quotas of its sources.
        fits = all(
            sum(uses[p] for p in some) <= sum(quotas[s] for s in {s for p in some for s in patterns[p]})
            for n in range(1, len(uses) + 1)
            for some in itertools.combinations(range(len(uses)), n)
        )
        if fits:
            cost = sum(k * min(s, max(0, u - k * s)) for u, s in zip(uses, sizes) for k in range(most))
            best = max(best, (total, -cost))
    return best


@pytest.mark.parametrize("seed", range(12))
def test_route_is_the_cheapest_full_flow(seed):
    rng = random.Random(seed)
    quotas = [rng.randint(0, 7) for _ in range(rng.randint(1, 3))]
    sizes = [rng.randint(0, 3) for _ in range(rng.randint(1, 3))]
    patterns = [sorted(rng.sample(range(len(quotas)), rng.randint(1, len(quotas)))) for _ in sizes]
    used, flows = mixing.route(quotas, patterns, sizes, 3)
    cost = sum(k * min(s, max(0, u - k * s)) for u, s in zip(used, sizes) for k in range(3))
    assert (sum(used), -cost) == cheapest(quotas, patterns, sizes, 3)
    assert sum(flows.values()) == sum(used)
    assert all(sum(n for (s, _), n in flows.items() if s == i) <= q for i, q in enumerate(quotas))


def test_targets_are_shared_out_up_to_three_times_the_size():
    targets = mixing.share_out([100, 10, 0, 50], [Fraction(w) for w in (5, 2, 1, 5)], 160, 3)
    assert targets == [Fraction(200, 3), Fraction(80, 3), 0, Fraction(200, 3)] and sum(targets) == 160
    assert all(t <= 3 * s for t, s in zip(targets, [100, 10, 0, 50]))
    assert sum(mixing.whole(targets)) == round(sum(targets))


def test_mix_by_source(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(1, 40), "en", rng.choice("aaabc"), 0) for i in range(400)]
    out = mixing.mix_by_source(spark.createDataFrame(rows, DOCS), [5, 2, 1]).collect()
    assert len(out) == 400
    for source in "abc":
        own = [r for r in out if r.source == source]
        assert own[0].source_size == sum(r.size for r in own)
        assert 0 <= own[0].target - sum(r.taken for r in own) + 1 <= 42
        assert len({r.repeats for r in own}) <= 2 and max(r.repeats for r in own) <= 3
    again = mixing.mix_by_source(spark.createDataFrame(rows, DOCS).repartition(7), [5, 2, 1]).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_mix_of_overlapping_sources(spark):
    rows = [(i, 1, ["a"] if i < 40 else ["a", "b"] if i < 60 else ["b"]) for i in range(80)]
    plan = mixing.mix(spark.createDataFrame(rows, "doc_id long, size long, sources array<string>"), {"a": 1, "b": 1}, total=80)
    taken = plan.repeats(spark.createDataFrame(rows, "doc_id long, size long, sources array<string>")).collect()
    assert sum(r.repeats for r in taken) == 80 and {r.repeats for r in taken} == {1}
    assert {r.source: (r.source_size, r.routed) for r in plan.summary.collect()} == {"a": (60, 40), "b": (40, 40)}


@pytest.mark.parametrize("seed", range(4))
def test_mix_goes_on_past_documents_that_do_not_fit(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randint(20, 400), [rng.choice("ab")]) for i in range(600)]
    rows += [(1000 + i, 60_000, ["a"]) for i in range(3)] + [(None, 7, ["a"])] * 40 + [(2000, 25, ["b"])] * 9
    df = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>")
    plan = mixing.mix(df, {"a": 2, "b": 1}, total=110_000, seed=seed)
    taken, routed = plan.repeats(df).collect(), {r.source: r.routed for r in plan.summary.collect()}
    for source in "ab":
        own = [r for r in taken if r.sources == [source]]
        short = routed[source] - sum(r.repeats * r["size"] for r in own)
        least, places = min(r.repeats for r in own), {}
        for r in own:
            places.setdefault((r.doc_id, r["size"]), []).append(r.repeats)
        assert all(len(set(x)) == 1 for x in places.values())
        unused = [k[1] * len(x) for k, x in places.items() if x[0] == least]
        assert 0 <= short < min(unused)
    again = plan.repeats(df.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, taken))


def test_mixing_awkward_rows(spark):
    out = mixing.mix_by_source(docs(spark), [5, 2, 1]).collect()
    assert len(out) == len(ODD)
    assert all(r["size"] == 0 and r.taken == 0 for r in out if r.doc_id in (2, 3, 4))
    assert all(r.taken <= 3 * r["size"] for r in out)
    assert mixing.mix_by_source(docs(spark, []), [5, 2, 1]).count() == 0


# --- 2: near-duplicates ---


def brute_components(rows, n, percent):
    sets = {}
    for i, text in rows:
        w = words((text or "").translate(LOWER))
        sets[i] = set(zip(*[w[k:] for k in range(n)])) if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def near_copies(seed, groups=12, each=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(each):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 20)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy) if rng.random() < 0.8 else "\t".join(copy).upper()))
    return rows


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, n, percent):
    rows = near_copies(n)
    out = by_id(dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), dedup.Rule(n, percent)))
    assert {i: tuple(r)[1:] for i, r in out.items()} == brute_components(rows, n, percent)


def test_a_hot_bucket_in_blocks(spark, monkeypatch):
    """One base with ever more edits, compared in blocks of a few classes."""
    monkeypatch.setattr(dedup, "BLOCK", 5)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(90):
        copy = list(base)
        for k in rng.sample(range(80), i // 9):
            copy[k] = f"x{i}_{k}"
        rows.append((i, " ".join(copy)))
    rng.shuffle(rows)
    out = by_id(dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), dedup.Rule(3, 85)))
    assert {i: tuple(r)[1:] for i, r in out.items()} == brute_components(rows, 3, 85)


def test_bayes_thresholds():
    rule = dedup.Rule(3, 85)
    least = rule.least_matches()
    assert least == sorted(least) and 0 < least[-1] < rule.functions
    assert (1 - 0.85**dedup.ROWS_IN_BAND) ** rule.bands <= rule.miss


def test_hashes_of_words_take_little_memory_and_do_not_depend_on_windows(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 1 << 20).astype(np.uint8)
    data[rng.random(len(data)) < 0.17] = 32
    data[300_000:700_000] = 101  # a word of several windows
    offsets = np.array([0, 0, 10, 250_000, 500_000, 900_000, len(data)])
    tracemalloc.start()
    hashes, first = dedup.WordHasher()(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20
    for step in (1 << 10, 1 << 20):
        monkeypatch.setattr(common, "_STEP", step)
        other, start = dedup.WordHasher()(data, offsets)
        assert (other == hashes).all() and (start == first).all()


def test_components_stop_once_all_edges_lead_to_the_least(spark, monkeypatch):
    rounds, cut = [], dedup.cut
    monkeypatch.setattr(dedup, "cut", lambda df: rounds.append(df) or cut(df))

    def found(links):
        rounds.clear()
        rows = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in links], "a binary, b binary")
        return sorted((r.cls[0], r.comp[0]) for r in dedup.components(rows).collect())

    assert found([(1, 2), (1, 3), (4, 1), (5, 6), (6, 5), (7, 7)]) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 5)]
    assert len(rounds) == 1  # no further round to see that nothing moves
    assert found([]) == [] and len(rounds) == 1
    chain = list(range(1, 60))
    random.Random(5).shuffle(chain)
    assert found(itertools.pairwise(chain)) == [(i, 1) for i in range(1, 60)]
    rng = random.Random(6)
    for _ in range(3):
        links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
        leader = list(range(60))
        for _ in leader:
            for a, b in links:
                leader[a] = leader[b] = min(leader[a], leader[b])
        assert found(links) == sorted((i, leader[i]) for i in {i for a, b in links if a != b for i in (a, b)})


def test_near_duplicates_awkward_rows(spark):
    out = dedup.near_duplicates(docs(spark), dedup.Rule(3, 85)).collect()
    assert len(out) == len(ODD)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}
    assert found[2] == found[3][:0] + (0, 2, True) and found[3] == (0, 3, True) and found[4] == (0, 4, True)
    assert found[8] == (12, 1, False) and found[1] == (12, 1, True)
    assert found[None][1:] == (None, True) and found[6] == (1, 6, True)
    assert dedup.near_duplicates(docs(spark, [])).count() == 0


def test_word_hashes_do_not_depend_on_their_place(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tablekeel.llm import common

    def hashes(texts):
        data, offsets = common.text_bytes(pa.array(texts))
        return common.WordHasher()(data, offsets)

    h, first = hashes(["Ab cd", None, "cd", "x" * 3_000_000 + " ab", "", "\x0bcd\x0c", "x" * 3_000_000])
    assert first.tolist() == [0, 2, 2, 3, 5, 5, 6, 7]
    assert h[1] == h[2] == h[5] and h[0] == h[4] and h[3] == h[6] and len(set(h.tolist())) == 3
    assert hashes([])[0].tolist() == [] and isinstance(h, np.ndarray)


# --- 3: languages ---


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 6, 7, 8, 9, 30):
        code = language.codewords(n)
        assert set(code.ravel()) == {-1.0, 1.0} and code.shape[0] == n
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= max(1, code.shape[1] // 3)


def test_language_accuracy_on_held_out_rows(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = language.identify_language(frame).join(frame.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 20
    assert sum(r.lang_pred == r.lang for r in out) / len(out) >= 0.95


def test_language_awkward_rows(spark):
    out = language.identify_language(docs(spark))
    rows = out.collect()
    assert len(rows) == len(ODD)
    found = {r.doc_id: r for r in rows}
    for i in (2, 3, 4, 5):
        assert (found[i].lang_pred, found[i].score, found[i].ambiguous) == ("und", 0.0, True)
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.identify_language(docs(spark, [])).count() == 0
    assert {r.lang_pred for r in language.identify_language(docs(spark, [(5, "some text", None, "a", 1)])).collect()} == {"und"}
    model = language.learn_languages(docs(spark))
    kept = language.predict_languages(docs(spark), model)
    assert kept.columns[-3:] == ["lang_pred", "score_", "ambiguous"]


# --- 4: licences ---


def test_canonical_forms_meet(spark):
    known = [("MIT", "Permission is hereby granted, free of charge."), ("X", "Licence of the Centre")]
    rows = [
        (1, "PERMISSION is hereby\n\n  granted -- free of charge\nCopyright (c) 2024 Somebody"),
        (2, "license of the center!"),
        (3, "Some words\nLicense of the centre\nmore\nPermission is hereby granted free of charge"),
        (4, "copyright nobody"),
        (5, None),
        (6, "license of the centers"),
    ]
    out = by_id(
        licenses.scan_licenses(
            spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_licenses(spark, known)
        )
    )
    assert [out[i].license_id for i in range(1, 7)] == ["MIT", "X", None, None, None, None]
    assert [out[i].notices for i in range(1, 7)] == ["", "X", "MIT,X", "", "", ""]
    assert out[4].text_digest is None and out[5].text_digest is None


def test_whole_licenses_are_found(spark):
    texts = licenses.whole_licenses()
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "Unlicense", "CC0-1.0"} <= {i for i, _ in texts}
    mit = next(t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 500).removeprefix("MIT License ")
    isc = next(t for i, t in licenses.KNOWN if i == "ISC")
    texts += [("MIT", mit), ("MIT", f"MIT License\n\nCopyright (c) 2020 Somebody\nAll rights reserved.\n\n{mit}"), ("ISC", f"{isc}\n  ALL RIGHTS RESERVED")]
    rows = [(i, t) for i, (_, t) in enumerate(texts)] + [(-1, "All rights reserved.\n"), (-2, f"{mit}\nNo rights reserved.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = by_id(licenses.scan_licenses(df))
    assert all(out[i].license_id == k for i, (k, _) in enumerate(texts))
    assert out[-1].license_id is None and out[-2].license_id is None and out[-1].text_digest is not None
    known = licenses.known_licenses(spark, [("OWN", "All rights reserved."), ("MIT", mit)])
    assert by_id(licenses.scan_licenses(df, known))[-1][2:] == ("OWN", "OWN")


def test_letters_of_all_scripts_count(spark):
    texts = ["Еще один текст 1", "ЕЩЕ ОДИН -- ТЕКСТ 1", "第三 1", "第四 1", "ΤΕΛΟΣ", "τελος", "हिन्दी", "हनद", "Straße", "Strae", "İ", "i", "—"]
    out = by_id(licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    digests = [out[i].text_digest for i in range(len(texts))]
    assert digests[0] == digests[1] and digests[4] == digests[5] and digests[10] == digests[11] and digests[12] is None
    assert len(set(digests)) == 10
    mixed = spark.createDataFrame([(1, "Это не лицензия. Licensed under the MIT License."), (2, "Licensed under the MIT License — №")], "doc_id long, text string")
    assert [by_id(licenses.scan_licenses(mixed))[i].license_id for i in (1, 2)] == [None, "MIT"]


def test_license_sql_agrees_on_whole_licenses_and_awkward_rows(spark):
    mit = next(t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 500)
    rows = [(100 + i, t.upper() if i % 2 else t) for i, (_, t) in enumerate(licenses.whole_licenses())]
    rows += [(r[0], r[1]) for r in ODD if r[0] not in (None, 8, 9)]
    rows += [
        (50, "Все права. All rights reserved.\n第三 1"),
        (51, f"Copyright 2001 X\nALL RIGHTS RESERVED.\n{mit}\n all rights reserved"),
        (52, f"intro\n{mit}\nLicensed under CC BY 4.0.\nCopyright me"),
        (53, "All rights reserved"),
        (54, "ΤΕΛΟΣ İ i Straße हिन्दी"),
    ]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    with duckdb.connect() as con:
        con.register("documents", documents)
        want = con.execute(licenses.oracle()).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(r[2] is not None for r in want) == len(licenses.whole_licenses()) + 1


def test_licenses_awkward_rows(spark):
    out = licenses.scan_licenses(docs(spark)).collect()
    assert len(out) == len(ODD)
    assert licenses.scan_licenses(docs(spark, [])).count() == 0
    plan = licenses.scan_licenses(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- 5: packing ---


def padding(histogram, ends):
    return sum(n * (min(e for e in ends if e >= x) - x) for x, n in histogram)


@pytest.mark.parametrize("seed", range(15))
def test_bucket_ends_are_the_best(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 8)))
    histogram = [(x, rng.randint(1, 20)) for x in lengths]
    for buckets in (1, 2, 3, 9):
        ends = packing.bucket_ends(histogram, buckets)
        assert len(ends) <= buckets and ends[-1] == lengths[-1]
        choices = itertools.chain.from_iterable(itertools.combinations(lengths[:-1], k) for k in range(min(buckets, len(lengths))))
        assert padding(histogram, ends) == min(padding(histogram, [*c, lengths[-1]]) for c in choices)


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 16)
    rng = random.Random(1)
    rows = [(i, int(rng.expovariate(0.02))) for i in range(500)] + [(1000, 9000), (1001, None), (1002, 0)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens long"), buckets=6, budget=1000).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows)
    packed = [r for r in out if r.n_tokens]
    assert all(r.batch is None and r.bucket is None for r in out if not r.n_tokens)
    batches = {}
    for r in packed:
        assert r.n_tokens <= r.padded
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, batch), own in batches.items():
        room = max(1, 1000 // own[0].padded)
        assert sorted(r.slot for r in own) == list(range(len(own))) and len(own) <= room
        last = max(b for k, b in batches if k == bucket)
        assert len(own) == room or batch == last
        assert len({r.padded for r in own}) == 1
    again = packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens long").repartition(5), buckets=6, budget=1000)
    assert sorted(map(str, again.collect())) == sorted(map(str, out))


def test_lengths_are_rounded_up_a_little(spark):
    values = [1, 32768, 32769, 40000, 65536, 65537, 10**6, 10**9, 2**40 + 1]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", packing.rounded(F.col("v")).alias("r")).collect()
    assert all(r.v <= r.r <= r.v * (1 + 1 / 128) for r in rows)
    assert all(r.r == r.v for r in rows if r.v <= 32768)


def test_long_documents_are_padded_to_the_longest_of_their_bucket(spark):
    lengths = [40_001, 40_002, 40_003, 99_999, 1_000_001, 7, 7, 9]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, n_tokens long")
    for name in ("bucket", "padded", "rank", "part", "n", "before", "place"):
        rows = rows.withColumn(name, F.lit("clash"))
    out = packing.pack(rows, buckets=4).collect()
    assert all(max(r.n_tokens for r in out if r.bucket == b) == p for b, p in {(r.bucket, r.padded) for r in out})
    assert {r.padded for r in out} == {9, 40_003, 99_999, 1_000_001}


def test_packing_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


# --- 6: quality ---


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    frame, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    out = quality.classify_quality(frame, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in out) / len(out) >= 0.9


def test_gradients_agree_with_differences():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.standard_normal((40, 7)).astype(np.float32)
    before = np.array([0, 3, 4, 11, 20, 21, 40])
    y = np.array([0, 1, 1, 0, 1, 0], np.float32)
    model = quality.fit(x, before, y, hidden=5, gate=4, epochs=300, seed=1)
    assert ((model.score(x, before) > 0.5) == (y == 1)).all()


def test_quality_learns_without_a_copy_of_all_features():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((20_000, quality.FEATURES)).astype(np.float32)
    before, y = np.arange(0, 20_001, 2), (rng.random(10_000) < 0.5).astype(np.float32)
    tracemalloc.start()
    quality.fit(x, before, y, hidden=4, gate=3, epochs=1, seed=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes / 2


def test_quality_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (6, 1, 0), (None, 0, 0), (5, None, 0), (9, 0, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    rows = quality.classify_quality(docs(spark), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    none = labels.where("false")
    assert {r.score for r in quality.classify_quality(docs(spark), none).collect()} == {0.5}
    assert quality.classify_quality(docs(spark, []), labels).count() == 0


def test_a_text_in_parts_has_the_same_score(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tablekeel.llm.common import WordHasher, text_bytes

    rng = random.Random(9)
    text = " " + " ".join(rng.choice(["ab", "Cd!!", "é", "x" * 700, "12 |"]) for _ in range(900)) + "\n"
    data, offsets = text_bytes(pa.array([text]))
    hasher = WordHasher()
    x, before = quality.passages(data, offsets, hasher)
    model = quality.fit(np.concatenate([x, x * 0.5]), np.array([0, 9, 2 * len(x)]), np.array([0, 1], np.float32), hidden=5, gate=4, epochs=20, seed=1)
    whole = model.score(x, before)[0]
    for size in (300, 5000, 20_000):
        monkeypatch.setattr(quality, "PART_BYTES", size)
        assert b"".join(p.tobytes() for p in quality.long_parts(data, hasher)) == data.tobytes()
        assert model.score_long(data, hasher) == pytest.approx(whole, abs=1e-4)


def test_long_texts_teach_by_passages_from_all_over(spark, monkeypatch):
    text = "".join(f"Word{i % 97} and {'!' * (i % 5)} more of it. " for i in range(4000))
    data, hasher = np.frombuffer(text.encode(), dtype=np.uint8), quality.WordHasher()
    x, before = quality.passages(data, np.array([0, len(data)]), hasher)
    at_once = quality.chosen(iter([x]), 64, 7)
    monkeypatch.setattr(quality, "PART_BYTES", 10_000)
    parts = [quality.passages(p, np.array([0, len(p)]), hasher)[0] for p in quality.long_parts(data, hasher)]
    assert len(parts) > 5 and before[-1] > 300
    in_parts = quality.chosen(iter(parts), 64, 7)
    assert at_once.shape == (64, quality.FEATURES) and (at_once == in_parts).all()
    places = [int(np.flatnonzero((x.astype(np.float16) == row).all(axis=1))[0]) for row in at_once]
    assert min(places) < len(x) / 10 and max(places) > len(x) * 9 / 10
    rows = [(i, ("Fine words here. " if i % 2 else "$$$ %%% ### ") * 30_000, None, None, None) for i in range(40)]
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality.learn_quality(docs(spark, rows), marks, passages_each=8)
    scores = by_id(quality.score_quality(docs(spark, rows[:2]).select("doc_id", "text"), model))
    assert scores[0].score < 0.3 < 0.7 < scores[1].score


def test_gradients_are_those_of_the_loss():
    """Each weight's gradient, as the first step of the fit uses it, against a difference of the loss."""
    rng = np.random.default_rng(3)
    before = np.array([0, 3, 4, 9])
    x, y = rng.standard_normal((9, 5)), np.array([1.0, 0.0, 1.0])
    seen = {}
    model = quality.fit(x.astype(np.float32), before, y.astype(np.float32), hidden=4, gate=3, epochs=1, seed=1)
    start = quality.fit(x.astype(np.float32), before, y.astype(np.float32), hidden=4, gate=3, epochs=0, seed=1)
    start.weights = {k: v.astype(np.float64) for k, v in start.weights.items()}

    def loss():
        score = start.score(x, before)
        return -np.mean(y * np.log(score) + (1 - y) * np.log(1 - score))

    for name, weights in start.weights.items():
        moved = model.weights[name] - weights  # Adam's first step has the sign of the gradient
        for at in np.ndindex(weights.shape):
            kept = weights[at]
            weights[at] = kept + 1e-5
            above = loss()
            weights[at] = kept - 1e-5
            slope = (above - loss()) / 2e-5 + 1e-5 * kept
            weights[at] = kept
            if abs(slope) > 1e-4:
                assert np.sign(moved[at]) == -np.sign(slope), (name, at)
                seen[name] = True
    assert set(seen) == set(start.weights)


def test_grams_in_windows(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tablekeel.llm.common import text_bytes

    data, offsets = text_bytes(pa.array(["Ünïcode tëxt of words", "", "ab", "x", None, "ÀÉ ÷ and more"]))

    def counts():
        out = [Counter() for _ in range(6)]
        for key, start in language.grams(data, offsets, 16):
            for i in range(6):
                out[i].update(key[start[i] : start[i + 1]].tolist())
        return out

    whole = counts()
    assert sum(whole[2].values()) == 1 and not whole[1] and not whole[3] and not whole[4]
    for size in (1, 3, 7):
        monkeypatch.setattr(language, "_WINDOW", size)
        assert counts() == whole
    assert np.diff(offsets).sum() == len(data)


def test_passages_cover_all_words():
    import numpy as np
    import pyarrow as pa

    from tablekeel.llm.common import WordHasher, text_bytes

    texts = ["a " * 85, "", None, "   ", "word", "b\n" * 40]
    x, before = quality.passages(*text_bytes(pa.array(texts)), WordHasher())
    assert np.diff(before).tolist() == [3, 1, 1, 1, 1, 1]
    assert np.expm1(x[:, -3]).round().tolist() == [40, 40, 5, 0, 0, 0, 1, 40]


# --- 7: tokens ---


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_token_counts_are_the_librarys(spark, model):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(2)
    alphabet = [" ", "\n", "  ", "▁", "a", "the", "é", "<s>", "\r", "\t", "中", "🙂", ".", "ing", " ", "\x00"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))) for i in range(2000)]
    rows += [(i + 5000, r[1]) for i, r in enumerate(ODD)]
    out = by_id(tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), model))
    for i, text in rows:
        assert out[i].n_tokens == len(processor.encode(text or "")), repr(text)[:80]
        assert out[i].n_bytes == len((text or "").encode()) and out[i].over_limit == (out[i].n_tokens > 4096)


def test_token_memory_is_bounded(model, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    counts = tokens.TokenCounts(model)
    assert counts.of(" ".join(f"zzq{i}" for i in range(100))) == sum(counts.of(f"zzq{i}") for i in range(100))
    assert len(counts) <= len(counts.proven) + 10


def test_tokens_awkward_rows(spark, model):
    assert tokens.count_tokens(docs(spark), model).count() == len(ODD)
    assert tokens.count_tokens(docs(spark, []), model).count() == 0


# --- 8: top-k ---


def brute_top(vectors, queries, k):
    out = []
    for q in queries:
        scored = [(-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("dim, scale", [(8, 256), (1, 3), (3, 2**40)])
def test_top_inner_products(spark, monkeypatch, dim, scale):
    monkeypatch.setattr(topk, "PART_VECTORS", 64)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 4)
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "FIRST_VECTORS", 10)
    rng = random.Random(dim)
    vectors = {i: [int(rng.gauss(0, scale)) // (1 + i % 5) for _ in range(dim)] for i in range(200)}
    vectors |= {200 + i: vectors[0] for i in range(9)}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, vector array<bigint>")
    if scale > 2**30:
        vectors = {i: [x >> 12 for x in v] for i, v in vectors.items()}
        frame = spark.createDataFrame(list(vectors.items()), "vec_id long, vector array<bigint>")
    out = topk.top_inner_products(frame, F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(map(tuple, out)) == brute_top(vectors, range(0, 209, 10), 5)


def test_top_k_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [None, 1.0]), (5, [0.0, -1.0]), (None, [1.0, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (100, [0.001, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.quantised(F.col("embedding"), 256).alias("vector"))
    out = topk.top_inner_products(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, out)) == [(0, 1, 100, 32768), (0, 2, 5, -32768), (100, 1, 0, 32768), (100, 2, 5, -65536)]
    assert topk.top_inner_products(frame.where("false"), F.col("vec_id") % 50 == 0).count() == 0


# --- 9: WARC ---


def test_warc_round_trip(spark, tmp_path):
    big = "<p>größer</p>" * 200
    rows = [
        (1, "http://a/x y", big), (2, None, None), (3, "http://b/", ""), (4, "http://c\r\nEvil: 1", big), (None, "http://d", big),
        (5, "http://e", "small\r\n\r\nWARC/1.1\r\n"), (5, "http://e", "small\r\n\r\nWARC/1.1\r\n"), (6, "http://f", "small\r\n\r\nWARC/1.1\r\n"),
        (7, "http://g", "\r\n\r\n" * 1000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit("clash"))
    out = warc.roundtrip(pages).collect()
    assert len(out) == len(rows)
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out)
    want = Counter()
    for i, _, html in rows:
        again = html == big and i != 4
        want[(i, len((html or "").encode()), digest(html), "revisit" if again else "response", 4 if again else None)] += 1
    assert got == want
    path = str(tmp_path / "w")
    warc.write_warc(pages, path)
    captures = warc.assemble(warc.read_warc(spark, path)).collect()
    assert {(c.page_id, c.url, bytes(c.response.payload).decode()) for c in captures if c.response.type == "response"} == {
        (i, u, h or "") for i, u, h in rows if h != big or i == 4
    }
    assert all(c.request.uri == c.response.uri for c in captures)
    assert warc.roundtrip(pages.where("false")).count() == 0


def test_warc_members_and_damage():
    import gzip

    one = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for data in (one * 3, gzip.compress(one * 3), gzip.compress(one) * 3):
        assert [b for _, b in warc.Records(data)] == [b"abc"] * 3
    for data in (one[:-6], one[:20], gzip.compress(one * 100)[:-9], b"HTTP/1.1 200 OK\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.Records(data))
    assert list(warc.Records(b"")) == []


def test_capture_without_all_records(spark):
    fields = "type string, record_id string, concurrent_to string, refers_to string, uri string, date string, digest string, payload_bytes long, payload_digest string, page_id long, url string, payload binary"
    rows = [("response", "r1", None, None, "u", "d", None, 1, "x", None, None, None), ("metadata", "m2", "r2", None, "u", "d", None, None, None, 9, "v", None)]
    out = {r.capture_id: r for r in warc.assemble(spark.createDataFrame(rows, fields)).collect()}
    assert out["r1"].request is None and out["r1"].metadata is None and out["r1"].response.payload_bytes == 1
    assert out["r2"].response is None and out["r2"].page_id == 9


# --- 10: fingerprints ---


def paragraphs(text):
    return set(re.findall(r"[^\n]{1,256}", text))


def alike(a, b):
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


@pytest.mark.parametrize("cells", [(5, 12), (1, 1), (2, 3)])
def test_fingerprints_against_sets(spark, monkeypatch, cells):
    """Also with sketches so small that shares get stuck and are retried larger, to the last way out."""
    monkeypatch.setattr(fingerprints, "BASE_CELLS", cells[0])
    monkeypatch.setattr(fingerprints, "SHARE_CELLS", cells[1])
    monkeypatch.setattr(fingerprints, "RANGE", 4)
    monkeypatch.setattr(fingerprints, "RANGES", 3)
    rng = random.Random(4)
    rows = [(i * rng.choice([1, 7, 50]) * 10 + i % 10, "\n".join(f"line {rng.randrange(300)}" for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows = list(dict(rows).items()) + [(-50, "é🙂" * 700), (10**9, "same\nsame\nx"), (10**9 + 1, "x\nsame")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = by_id(fingerprints.fingerprint_edits(frame))
    ordered = sorted(rows)
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert out[i].n_chars == len(text)
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i].near_edited == pytest.approx(alike(paragraphs(text), paragraphs(edited)))
        assert out[i].near_next == pytest.approx(alike(paragraphs(text), paragraphs(after)))
    assert out[10**9].fingerprint == out[10**9 + 1].fingerprint
    plan = fingerprints.fingerprint_edits(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_work_grows_with_the_paragraphs(spark):
    """A text of two megabytes, and many rows of one id; time per paragraph does not grow much with their number."""
    rng = random.Random(6)
    page = lambda n: "\n".join(f"{rng.random()}" for _ in range(n))
    times = {}
    for n in (2_000, 500, 4_000):  # the first also warms up
        frame = spark.createDataFrame([(i, page(n)) for i in range(4)], "doc_id long, text string").coalesce(1)
        start = time.perf_counter()
        rows = fingerprints.fingerprint_edits(frame).collect()
        times[n] = time.perf_counter() - start
        assert all(r.near_next == 0 and 0.4 < r.near_edited < 0.6 for r in rows)
    assert times[4_000] < 16 * max(times[500], 0.5)
    long = spark.createDataFrame([(1, page(110_000)), (2, page(3))] + [(3, page(40))] * 300, "doc_id long, text string")
    rows = fingerprints.fingerprint_edits(long).collect()
    assert max(r.n_chars for r in rows) > 2_000_000 and sum(r.near_next == 1.0 for r in rows) == 299


def test_fingerprints_awkward_rows(spark):
    out = fingerprints.fingerprint_edits(docs(spark)).collect()
    assert len(out) == len(ODD)
    found = {r.doc_id: r for r in out}
    assert found[2].n_chars == 0 and found[2].near_next == 1.0 and found[None].near_next == 0.0
    assert [r.near_next for r in out if r.doc_id == 8].count(1.0) == 1
    assert fingerprints.fingerprint_edits(docs(spark, [])).count() == 0
    alone = fingerprints.fingerprint_edits(docs(spark, [(5, "abcd", None, None, 0)])).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
