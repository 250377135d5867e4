"""Katz backoff against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from reelrank.llm import katz

SCHEMA = "doc_id long, text string, score string, held boolean"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
START, END = object(), object()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


class Model:
    """The same model, with sums over all words where the library sums what is left."""

    def __init__(self, texts):
        self.one, self.two = Counter(), defaultdict(Counter)
        for words in texts:
            before = START
            for word in [*words, END]:
                self.one[word] += 1
                self.two[before][word] += 1
                before = word
        self.n = sum(self.one.values())
        self.first = self.discounts(Counter(self.one.values()))
        self.second = self.discounts(Counter(c for m in self.two.values() for c in m.values()))
        self.unknown = 1 - sum(self.single(w) for w in self.one) if self.n else 1.0

    @staticmethod
    def discounts(n):
        k = 5
        if all(n[r] for r in range(1, k + 2)):
            spare = (k + 1) * n[k + 1] / n[1]
            found = [((r + 1) * n[r + 1] / n[r] / r - spare) / (1 - spare) for r in range(1, k + 1)]
            if all(0 < f < 1 for f in found):
                return lambda c: c * found[c - 1] if c <= k else c
        d = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        return lambda c: c - d

    def single(self, word):
        return self.first(self.one[word]) / self.n if self.one[word] else self.unknown

    def after(self, context, word):
        seen = self.two.get(context)
        if not seen:
            return self.single(word)
        total = sum(seen.values())
        left = total - sum(self.second(c) for c in seen.values())
        scale = 1.0
        if left < 1e-9:
            scale, left = total / (total + 1), total / (total + 1)
        if seen[word]:
            return scale * self.second(seen[word]) / total
        rest = self.unknown + sum(self.single(w) for w in self.one if w not in seen)
        return left / total / rest * self.single(word)

    def score(self, words):
        chain = [START, *words, END]
        return sum(math.log10(self.after(a, b)) for a, b in zip(chain, chain[1:], strict=False))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check(spark, rows, **settings):
    frame = spark.createDataFrame([(*row, "old", True) for row in rows], SCHEMA)
    got = katz.score(katz.split(frame), **settings).collect()
    words = [(i, WORD.findall(lower(text or ""))) for i, text in rows]
    model = Model([w for i, w in words if not held_out(i)])
    kinds = len(model.one)
    expected = []
    for i, w in words:
        counts = [model.one[x] for x in [*w, END]]
        base = sum(math.log10((c + 1) / (model.n + kinds + 1)) for c in counts)
        known = sum(c > 0 for c in counts)
        expected.append((i, held_out(i), len(counts), known, model.n, base, model.score(w)))
    order = lambda row: (row[0] is None, row[0] or 0, row[6])
    got, expected = sorted(map(tuple, got), key=order), sorted(expected, key=order)
    assert [row[:5] for row in got] == [row[:5] for row in expected]
    for a, b in zip(got, expected, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    return model


@pytest.fixture(scope="module")
def rows(texts):
    rng = random.Random(2)
    zipf = [f"v{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    made = [" ".join(rng.choice(zipf) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    out = list(enumerate(t for t in [*texts, *made] if len(t or "") < 20_000))
    return out + [(None, "no id"), (3, "again"), (-5, "The THE Ünder"), (9, made[3]), (10, made[3])]


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"block_tokens": 200, "bigram_tokens": 300, "word_tokens": 500, "spread_tokens": 40},
        {"block_tokens": 1, "bigram_tokens": 2_000, "spread_tokens": 1},
    ],
)
def test_scores(spark, rows, settings):
    check(spark, rows, **settings)


def test_probabilities_add_up(spark, rows):
    model = check(spark, rows[:60])
    for context in [START, "w1", *list(model.two)[:20], "never"]:
        total = sum(model.after(context, word) for word in [*model.one, "never"])
        assert total == pytest.approx(1, abs=1e-9)


def test_odd_tables(spark):
    check(spark, [(1, "a a a a a a a a a a a a a a a a"), (2, "a a a a a a a a a")])
    check(spark, [(1, None), (2, ""), (3, " \n")])
    nothing = [(i, "only held out") for i in range(200) if held_out(i)]
    check(spark, nothing)
    long = " ".join(f"x{n % 50}" for n in range(40_000))
    check(spark, [(1, long), (2, "x1 x2 y")], block_tokens=1_000)
    frame = spark.createDataFrame([], SCHEMA)
    assert katz.score(katz.split(frame)).collect() == []


def test_packing():
    arrays = [np.array([], dtype=np.int64), np.array([0, 5, 1 << 40, -1]), np.array([True, False])]
    back = katz.unpack(katz.pack(*arrays, np.array([0.5, -1.25])))
    assert [a.tolist() for a in back[:3]] == [a.astype(np.int64).tolist() for a in arrays]
    assert back[3].view(np.float64).tolist() == [0.5, -1.25]
