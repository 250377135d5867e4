"""The source divergence audit against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reelrank.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, rank int, value string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", TERM.findall(lower(text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter()
        groups = defaultdict(Counter)
        for l, s, words in docs:
            if l == lang:
                seen.update(set(words))
                groups[s].update(words)
        kept = sorted((t for t, n in seen.items() if n >= min_docs), key=str.encode)
        total = Counter()
        for c in groups.values():
            total.update(c)

        def p(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = p(total)
        own = {s: p(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(sum(abs(own[s][t] - own[o][t]) for t in kept), o) for o in groups if o != s]
            pairs.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", o, v, i + 1) for i, (v, o) in enumerate(pairs)]
            terms = [(own[s][t] - q[t], t) for t in kept if groups[s][t] and own[s][t] > q[t]]
            terms.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", t, v, i + 1) for i, (v, t) in enumerate(terms[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["The", "the", "é", "Éa", "日本", "x1y", "don't", "B_C", "\U0001f600z", "Ω"] + [
        f"w{chr(97 + n)}{chr(97 + n % 7)}" for n in range(20)
    ]
    out = []
    for n in range(160):
        text = " ".join(rng.choice(words[n % 9 :]) for _ in range(rng.randint(0, 40)))
        out.append((text, rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "é", None, ""])))
    out += [(None, "en", "empty"), ("", "en", "blank"), ("rare", "xx", "q"), ("rare", "xx", "r")]
    out += [("123 \x00 _", "en", "a"), ("long " * 30_000, "fr", "a")] + [out[0]] * 3
    return out


@pytest.mark.parametrize("block", [2, 256])
def test_audit(spark, rows, block, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", block)
    frame = spark.createDataFrame(
        [(i, *row, i, "old") for i, row in enumerate(rows)], SCHEMA
    ).repartition(3)
    found = divergence.audit(frame, min_docs=4, top_terms=5)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 4, 5)


def test_nothing_kept_and_nothing_there(spark, rows):
    frame = spark.createDataFrame([(i, *row, i, "old") for i, row in enumerate(rows)], SCHEMA)
    found = divergence.audit(frame, min_docs=10_000).collect()
    assert {(r["part"], r["value"]) for r in found} == {("pair", 0)}
    assert sorted(tuple(r) for r in found) == brute(rows, 10_000, 50)
    assert divergence.audit(frame.limit(0)).collect() == []


def test_shares_of_terms_add_up(spark):
    groups = spark.createDataFrame(
        [(1, "en", 0, 2, 3, 9), (2, "en", 1, 2, 5, 9), (3, "en", 1, 2, 4, 9)],
        "group_no long, lang string, block int, blocks int, none long, kept long",
    )
    terms = [(1, 0, 10), (1, 1, 20), (2, 1, 7), (3, 5, 50)]
    frame = spark.createDataFrame(terms, "group_no long, term_no int, p long")
    none = {1: 3, 2: 5, 3: 4}
    p = {(g, t): v for g, t, v in terms}
    expected = {
        (a, b): sum(abs(p.get((a, t), none[a]) - p.get((b, t), none[b])) for t in range(9))
        for a in none for b in none if a != b
    }
    for parts in (1, 4):
        found = divergence.pair_values(groups, frame, parts).collect()
        assert {(r.a, r.b): r.value for r in found} == expected and len(found) == 6


def test_more_languages_than_marks(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "_MARKS", divergence._MARKS[:2])
    frame = spark.createDataFrame([(i, *row, i, "old") for i, row in enumerate(rows)], SCHEMA)
    found = divergence.audit(frame, min_docs=4, top_terms=5)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 4, 5)


def test_repeated_terms_are_sent_once(spark):
    lists = pa.array([["a", "b", "a", "a"], [], ["b", "a", "c"], ["c"] * 1_000])
    once = divergence._once(lists.slice(1))
    assert once.to_pylist() == [[], ["b", "a", "c"], ["c"]]
    batches = list(divergence._by_power(np.array([7, 9, 7, 7]), lists))
    sums, sent = Counter(), 0
    for batch in batches:
        for row in batch.to_pylist():
            assert len(row["terms"]) == len(set(row["terms"]))
            sums.update({(row["group_no"], term): row["times"] for term in row["terms"]})
            sent += len(row["terms"])
    assert sums == {(7, "a"): 4, (7, "b"): 2, (7, "c"): 1_001} and sent == 9
    assert list(divergence._by_power(np.array([7]), lists.slice(1, 1))) == []

    frame = spark.createDataFrame([(0, "x Y x " * 500, "en", "s", 0, "")] * 2, SCHEMA)
    own = divergence.document_terms(frame, {"en": 32}).collect()
    assert [sorted(row.terms) for row in own] == [[" x", " y"]] * 2
    rows = divergence.group_terms(frame.coalesce(1), {"en": 32}).collect()
    assert sum(len(row.terms) for row in rows) < 20
    assert sum(row.times for row in rows if " x" in row.terms) == 2_000
