"""Vector codes against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from reelrank.llm import codes

SCHEMA = "vec_id long, label int, embedding array<float>, code string, _label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Codes and errors by comparing every part with every entry."""
    kept = [
        (vec_id, label, [math.floor(256 * x) for x in vector])
        for vec_id, label, vector in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    width = max(1, -(-max(len(v) for _, _, v in kept) // parts))
    cut = [
        (vec_id, label, [(v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width]
                         for p in range(parts)])
        for vec_id, label, v in sorted(
            kept, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[2])
        )
    ]
    books = [[list(row[2][p]) for row in cut[:entries]] for p in range(parts)]

    def near(p, x):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return min(range(len(gaps)), key=gaps.__getitem__), min(gaps)

    for _ in range(rounds):
        found = [[near(p, row[2][p])[0] for p in range(parts)] for row in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [row[2][p] for row, f in zip(cut, found, strict=True) if f[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = []
    for vec_id, label, x in cut:
        best = [near(p, x[p]) for p in range(parts)]
        code = "".join(f"{e:02x}" for e, _ in best)
        out.append((vec_id, label, code, sum(d for _, d in best)))
    flat = ",".join(str(c) for book in books for entry in book for c in entry)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


@pytest.mark.parametrize("dims, n", [(64, 300), (20, 40), (16, 90)])
def test_codes(spark, dims, n):
    rng = random.Random(dims)
    rows = [
        (i, rng.choice([0, 1, None]), [round(rng.gauss(0, 0.2), 3) for _ in range(dims)])
        for i in rng.sample(range(1000), n)
    ]
    rows += [(None, 1, rows[0][2]), (rows[1][0], None, rows[2][2]), (5000, 0, rows[3][2])]
    rows += [(5001, 0, None), (5002, 0, [None] + rows[0][2][1:]), (5003, 0, [math.nan] * dims)]
    rows += [(5004, 1, [math.inf] * dims), (5005, 1, []), (5006, None, rows[0][2][:7])]
    rows = [(i, a, v and [None if x is None else float(np.float32(x)) for x in v]) for i, a, v in rows]
    frame = spark.createDataFrame([(*row, "old", 7) for row in rows], SCHEMA)
    expected, digest = brute(rows)
    sums = {}
    for _, label, _, error in expected:
        sums[label] = sums.get(label, 0) + error
    found = codes.report(frame.repartition(5)).collect()
    assert {row.codebooks_sha256 for row in found} == {digest}
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=key)
    assert got == sorted(((i, c, e, sums[a]) for i, a, c, e in expected), key=key)


def test_nothing_usable(spark):
    frame = spark.createDataFrame([(1, 1, None, "", 1)], SCHEMA)
    assert codes.report(frame).collect() == []
    assert codes.report(frame.limit(0)).columns == [
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    ]


def test_memo_evaluates_few_entries_exactly():
    rng = np.random.default_rng(1)
    entries = rng.integers(-100, 100, (64, 4))
    entries[7] = entries[3]  # a tie: the lower number wins
    points = np.concatenate([rng.integers(-100, 100, (4000, 4)), entries])
    gaps = ((points[:, None, :] - entries) ** 2).sum(axis=2)
    for limit in (50, 1 << 15):
        memo = codes.CellMemo(entries, limit=limit)
        for start in range(0, len(points), 40):
            part = slice(start, start + 40)
            number, gap = memo.nearest(points[part])
            assert (number == gaps[part].argmin(axis=1)).all()
            assert (gap == gaps[part].min(axis=1)).all()
        assert memo.evaluated < len(points) * 64 / 4
    again = memo.built
    memo.nearest(points)
    assert memo.built == again
    # Far numbers stay exact.
    far = np.array([[codes.LIMIT, -codes.LIMIT, 0, 1]])
    assert memo.nearest(far)[1][0] == ((far - entries) ** 2).sum(axis=1).min()
