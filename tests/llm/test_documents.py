"""Operators on documents against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from reelrank.llm import jaccard, lines, mixing, quality, substring

from .conftest import make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def xx(*parts):
    """Spark's xxhash64 of strings and longs."""
    seed = 42
    for part in parts:
        data = part.encode() if isinstance(part, str) else (part % (1 << 64)).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def repeated_words(words):
    seen = defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    gone = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(8)}
    return len(gone)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return make(spark, texts)


def test_quality(spark, docs, texts):
    trusted = spark.createDataFrame([(i,) for i in range(8, 30)] + [(None,), (9,)], "doc_id long")
    got = by_id(quality.quality(docs.withColumn("score", docs.doc_id), trusted, threshold=-0.02))
    raw, target = Counter(), Counter()
    grams = {}
    for i, text in enumerate(texts):
        hashes = [xx(w) for w in WORD.findall(text or "")]
        grams[i] = hashes + [xx(a, b) for a, b in zip(hashes, hashes[1:], strict=False)]
        counts = Counter(h % quality.BUCKETS for h in grams[i])
        raw += counts
        target += counts if i in range(8, 30) else Counter()
    totals = [sum(c.values()) + quality.BUCKETS for c in (raw, target)]
    kinds = set()
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        solid = [line for line in (text or "").split("\n") if WORD.search(line)]
        repeats = repeated_words(words)
        failed = len(words) < 20 or 100 * repeats > 30 * len(words)
        score = 0.0
        if words:
            score = sum(
                math.log((target[h % quality.BUCKETS] + 1) / (raw[h % quality.BUCKETS] + 1))
                + math.log(totals[0] / totals[1])
                for h in grams[i]
            ) / len(grams[i])
        row = got[i]
        assert (row.n_words, row.word_chars) == (len(words), sum(map(len, words)))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert (row.n_dup_lines, row.n_repeat_words) == (len(solid) - len(set(solid)), repeats)
        assert row.base_failed == failed
        assert row.score == pytest.approx(score, abs=1e-6)
        assert row.kept == (not failed and row.score >= -0.02)
        kinds.add((failed, row.kept))
    assert len(kinds) == 3


def test_quality_of_nothing(spark, docs):
    none = spark.createDataFrame([], "doc_id long")
    assert quality.quality(docs.limit(0), none).count() == 0
    assert quality.quality(docs, none).count() == docs.count()


def test_quality_counts_all_trusted_documents(spark):
    ids = spark.range(60_000).withColumnRenamed("id", "doc_id")
    docs = quality.hashed(ids.selectExpr("doc_id", "concat('w', doc_id % 7, ' same') as text"))
    # The corpus is the trusted text, so the two multinomials are one.
    ratios = quality.log_ratios(docs, ids).first()["ratios"]
    assert len(ratios) == quality.BUCKETS
    assert max(map(abs, ratios)) < 1e-12


def test_line_dedup(spark):
    shared, near = "on every site of them", "on four sites"
    texts = [f"{shared}\nown {i}\n\n{near if i < 4 else 'other'}\n{shared}" for i in range(6)]
    texts += [None, "", shared]
    sources = [f"s{i}" for i in range(6)] + ["s0", None, None]
    docs = make(spark, texts, sources)
    got = by_id(lines.line_dedup(docs.withColumn("n_lines", docs.doc_id), min_sites=5))
    assert got[0].text == texts[0] and got[0].n_removed == 0
    assert got[3].text == f"own 3\n\n{near}" and got[3].n_removed == 2
    assert got[3].n_chars == len(got[3].text)
    assert got[6].text is None and got[7].text == "" and got[8].text == ""
    assert by_id(lines.line_dedup(docs, min_sites=7))[5].text == texts[5]
    wide = by_id(lines.line_dedup(docs, min_sites=4, margin=0.0))
    assert wide[3].text == "own 3\n"
    assert lines.line_dedup(docs.limit(0)).count() == 0


def jaccard_truth(texts):
    sets = []
    for text in texts:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = WORD.findall(lowered)
        if len(words) < 5:
            sets.append({tuple(words)} if words else set())
        else:
            sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((find(i), find(j)))
                label[high] = low
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_jaccard(spark, docs, texts):
    got = by_id(jaccard.near_duplicates(docs))
    found = [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))]
    assert found == jaccard_truth(texts)
    kept = {row.doc_id for row in jaccard.keep_one(docs).collect()}
    assert kept == {i for i, (_, c) in enumerate(found) if c == i}


def test_jaccard_of_repeats_and_nothing(spark, docs):
    twice = docs.unionByName(docs)
    assert jaccard.near_duplicates(twice).count() == docs.count()
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_jaccard_compares_across_components(spark, monkeypatch):
    """Families that only meet under keys led by another document."""
    import random

    rng = random.Random(5)
    texts = []
    for _ in range(40):
        base = [f"v{rng.randint(0, 60)}" for _ in range(14)]
        for _ in range(4):
            copy = list(base)
            copy[rng.randint(0, 13)] = f"v{rng.randint(0, 60)}"
            texts.append(" ".join(copy))
        texts.append(" ".join(base[:9]))
    monkeypatch.setattr(jaccard, "CELL_ROWS", 2)
    got = by_id(jaccard.near_duplicates(make(spark, texts)))
    found = [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))]
    assert found == jaccard_truth(texts)


def test_sketch_bounds_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 7, 50, 900):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 5 :], rng.integers(0, 1 << 63, 3, dtype=np.uint64)]))
        truth = len(np.setxor1d(a, b))
        assert jaccard.least_difference(jaccard.bit_sketch(a), jaccard.bit_sketch(b)) <= truth


def test_cells_compare_as_pair_by_pair(monkeypatch):
    """Pairs of a cell come from array operations, in steps of any length, not from a call each."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    rows = []
    for cell in range(-6, 6):
        base = np.unique(rng.integers(0, 1 << 63, (3, 33, 66, 200)[cell % 4], dtype=np.uint64))
        for _ in range(12):
            left = base[rng.random(len(base)) > rng.random() * 0.15]
            added = rng.integers(0, 1 << 63, len(base) // 8, dtype=np.uint64)
            part = np.unique(np.concatenate([base[:1], left, added]))
            side, comp = (2 if cell % 2 else int(rng.integers(0, 2))), int(rng.integers(0, 5))
            rows.append((cell, side, len(rows), comp, len(part), jaccard.bit_sketch(part)))
    expected = {
        (a[2], b[2])
        for a in rows
        for b in rows
        if a[0] == b[0] and a[2] < b[2] and a[3] != b[3] and (a[1] == 2 or a[1] != b[1])
        and 5 * a[4] >= 4 * b[4] and 5 * b[4] >= 4 * a[4]
        and jaccard.least_difference(a[5], b[5]) <= jaccard.most_different(a[4], b[4])
    }
    assert len({len(r[5]) for r in rows}) > 3 and 50 < len(expected) < 600
    names = ["cell", "side", "doc_id", "comp", "n_shingles", "sketch"]
    table = pa.table(dict(zip(names, zip(*rows))))
    by_id = {r[2]: r for r in rows}
    pairs = [(a, b) for a in by_id for b in by_id if (a * b) % 7 == 0]
    sides = {
        f"{name}_{s}": [by_id[p[k]][column] for p in pairs]
        for k, s in enumerate("ab")
        for name, column in (("n", 4), ("sketch", 5))
    }
    beside = pa.table({"a": [a for a, _ in pairs], "b": [b for _, b in pairs], **sides})
    fit = [
        (a, b)
        for a, b in pairs
        if jaccard.least_difference(by_id[a][5], by_id[b][5])
        <= jaccard.most_different(by_id[a][4], by_id[b][4])
    ]

    def called(*_):
        raise AssertionError("a call per pair")

    monkeypatch.setattr(jaccard, "least_difference", called)
    for held in (1 << 20, 7):
        monkeypatch.setattr(jaccard, "COMPARED", held, raising=False)
        found = [
            pair
            for batch in jaccard._cells(iter(table.to_batches(max_chunksize=50)))
            for pair in zip(batch["a"].to_pylist(), batch["b"].to_pylist())
        ]
        assert len(found) == len(set(found)) and set(found) == expected
        sifted = pa.Table.from_batches(jaccard._sift(iter(beside.to_batches(max_chunksize=500))))
        assert [*zip(sifted["a"].to_pylist(), sifted["b"].to_pylist())] == fit


def test_mixing(spark, texts):
    sources = [["b", "a", None, "c", "hot", "hot", "hot"][i % 7] for i in range(len(texts))]
    docs = make(spark, texts, sources)
    got = by_id(mixing.mix(docs.withColumn("target", docs.doc_id)))
    size = {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}
    names = sorted({s for s in sources if s}) + [None]
    total = {n: sum(size[i] for i, s in enumerate(sources) if s == n) for n in names}
    weight = {n: mixing.WEIGHTS[k % 3] for k, n in enumerate(names)}
    target, left, free = {}, 1.5 * sum(size.values()), set(names)
    while True:
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        full = {n for n in free if share[n] > 2 * total[n]}
        if not full:
            break
        for n in full:
            target[n] = 2.0 * total[n]
            left -= target[n]
        free -= full
    target |= share
    for n in names:
        rows = [got[i] for i, s in enumerate(sources) if s == n]
        assert all(r.target == pytest.approx(target[n]) and r.source_size == total[n] for r in rows)
        assert sum(r.taken for r in rows) == pytest.approx(target[n], abs=1.001)
    assert all(r["taken"] <= 2 * r["size"] == 2 * size[i] for i, r in got.items())
    again = by_id(mixing.mix(docs.repartition(3)))
    assert {i: r.taken for i, r in again.items()} == {i: r.taken for i, r in got.items()}
    copies = Counter(r.doc_id for r in mixing.repeated(mixing.mix(docs), docs.columns).collect())
    for i, r in got.items():
        assert copies[i] == (math.floor(r.taken / r["size"] + 0.5) if r["size"] else 0)


def test_mixing_of_nothing(spark, docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = mixing.mix(make(spark, [None, ""])).collect()
    assert [(r["size"], r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def substring_truth(texts):
    words = [WORD.findall(text or "") for text in texts]
    first = {}
    for doc, own in enumerate(words):
        for i in range(len(own) - 12):
            first.setdefault(tuple(own[i : i + 13]), doc)
    out = []
    for doc, own in enumerate(words):
        gone = set()
        for i in range(len(own) - 12):
            if first[tuple(own[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("index_words", [50, 400_000])
def test_substring(spark, docs, texts, monkeypatch, index_words):
    monkeypatch.setattr(substring, "INDEX_WORDS", index_words)
    more = docs.unionByName(spark.createDataFrame([(None, "a b", None, None, 3)], docs.schema))
    got = by_id(substring.substring_dedup(more))
    assert got.pop(None).n_words == 2
    found = [tuple(got[i])[1:] for i in range(len(texts))]
    assert found == substring_truth(texts)
    assert sum(row[1] for row in found) > 1000


def test_substring_of_nothing(spark, docs):
    assert substring.substring_dedup(docs.limit(0)).count() == 0


def test_fm_index_counts_patterns():
    import numpy as np

    rng = np.random.default_rng(2)
    text = np.append(rng.integers(1, 5, 400), 0)
    index = substring.FMIndex(text)
    ends = np.arange(13, 400)
    length, low, high = index.matching_statistics(text, ends)
    assert (length == 13).all()
    content = text.tolist()
    for end, lo, hi in zip(ends[:60], low, high, strict=False):
        pattern = content[end - 13 : end]
        count = sum(content[i : i + 13] == pattern for i in range(len(content) - 12))
        assert hi - lo == count
