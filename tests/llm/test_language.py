"""Language codes against the same method written plainly, one n-gram at a time."""

import math
import unicodedata
import zlib
from collections import Counter

import numpy as np

from tablekeel.llm import language
from tablekeel.llm.common import mixed

BITS, SMOOTHING = 16, 0.05


def plain_grams(text):
    """The buckets of all n-grams of two and three bytes but those that begin and end in a gap."""
    b = list(text.encode())
    for i, c in enumerate(text.encode()):
        if c < 128:
            b[i] = c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32
        elif i and text.encode()[i - 1 : i] == b"\xc3" and 0x80 <= c <= 0x9E and c != 0x97:
            b[i] = c + 32
    codes = []
    for n in (2, 3):
        for i in range(len(b) - n + 1):
            if b[i] != 32 or b[i + n - 1] != 32:
                codes.append(int.from_bytes(bytes(b[i : i + n]), "big") * 4 + n - 1)
    return [int(k) >> (64 - BITS) for k in mixed(np.array(codes, dtype=np.uint64))]


class Plain:
    def __init__(self, rows):
        self.languages = sorted({lang for _, lang in rows})
        self.counts = {lang: Counter() for lang in self.languages}
        for text, lang in rows:
            self.counts[lang].update(plain_grams(text))
        self.sums = {lang: sum(c.values()) + SMOOTHING * 2**BITS for lang, c in self.counts.items()}
        self.code = language.codewords(len(self.languages)).tolist()
        seen = set().union(*self.counts.values())
        self.strength = []
        for k in range(len(self.code[0])):
            terms = [(r - w) * math.log(r / w) for r, w in (self.sides(g, k) for g in seen)]
            right, wrong = self.sides(None, k)
            self.strength.append(math.fsum(terms) + (2**BITS - len(seen)) * (right - wrong) * math.log(right / wrong))

    def sides(self, gram, k):
        share = [(self.counts[x][gram] + SMOOTHING) / self.sums[x] for x in self.languages]
        sides = [[s for s, word in zip(share, self.code, strict=True) if word[k] * sign > 0] for sign in (1, -1)]
        return [sum(side) / len(side) for side in sides]

    def decide(self, text):
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            return "und", 0.0
        found = Counter(plain_grams(text))
        shrink = min(1.0, 100 / max(1, sum(found.values()))) / 2
        mean = sum(self.strength) / len(self.strength)
        loss = [0.0] * len(self.languages)
        for k, strength in enumerate(self.strength):
            margin = shrink * math.fsum(n * math.log(r / w) for g, n in found.items() for r, w in [self.sides(g, k)])
            for i, word in enumerate(self.code):
                loss[i] += strength / mean * float(np.logaddexp(0, -margin * word[k]))
        belief = [math.exp(min(loss) - x) for x in loss]
        best = max(range(len(loss)), key=lambda i: belief[i])
        return self.languages[best], belief[best] / sum(belief)


def test_every_document_is_decoded_as_by_plain_loops(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = frame.select("doc_id", "text", "lang").collect()
    taught = [(r.text, r.lang) for r in rows if r.text is not None and r.lang and zlib.crc32(str(r.doc_id).encode()) % 5]
    assert taught and len(taught) < 20_000 / len({lang for _, lang in taught})  # the sample is all rows
    model = Plain(taught)
    out = {r.doc_id: r for r in language.identify_language(frame).collect()}
    assert len(out) == len(rows)
    for r in rows:
        lang, score = model.decide(r.text)
        found = out[r.doc_id]
        assert found.lang_pred == lang and abs(found.score - score) < 1e-3, (r.doc_id, lang, score, found)
        assert found.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert found.ambiguous == (lang == "und" or score < 0.6) or abs(score - 0.6) < 1e-3
