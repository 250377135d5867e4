"""The FM-index on patterns that it does not hold, and how much work it does."""

import numpy as np
import pyarrow as pa
import pytest

from reelrank.llm import substring


def text_of(seed, n, symbols):
    return np.append(np.random.default_rng(seed).integers(1, symbols, n), 0)


@pytest.mark.parametrize(("n", "symbols"), [(1, 2), (12, 3), (700, 4), (700, 90), (300, 70_000)])
def test_longest_matches_of_other_patterns(n, symbols):
    text = text_of(4, n, symbols)
    # 0 ends the text, and the largest number is not below the pattern's.
    text[0] = max(text.max(), symbols - 1)
    index = substring.FMIndex(text)
    other = np.concatenate([text_of(5, 200, symbols)[:-1], text[:40], text_of(6, 9, symbols)[:-1]])
    other = other[other > 0]
    ends = np.arange(substring.WINDOW, len(other))
    length, low, high = index.matching_statistics(other, ends)
    content = text.tolist()
    for end, size, lo, hi in zip(ends, length, low, high, strict=True):
        held = list(range(len(content)))
        for back in range(1, substring.WINDOW + 1):
            pattern = other[end - back : end].tolist()
            found = [i for i in range(len(content)) if content[i : i + back] == pattern]
            if not found:
                break
            held = found
        else:
            back += 1
        assert size == back - 1
        assert sorted(index.order[lo:hi].tolist()) == held


def test_a_pattern_found_once_leaves_the_wavelet_tree(monkeypatch):
    places = []
    descend = substring.WaveletTree.descend

    def counted(tree, symbol, place):
        places.append(place.size)
        return descend(tree, symbol, place)

    text = text_of(7, 5000, 50)
    index = substring.FMIndex(text)
    ends = np.arange(substring.WINDOW, len(text) - 1)
    monkeypatch.setattr(substring.WaveletTree, "descend", counted)
    length, low, high = index.matching_statistics(text, ends)
    assert (length == substring.WINDOW).all() and (high - low == 1).all()
    assert (index.order[low] == ends - substring.WINDOW).all()
    assert sum(places) < 6 * len(ends)


def test_equal_patterns_go_down_the_wavelet_tree_once(monkeypatch):
    places = []
    descend = substring.WaveletTree.descend

    def counted(tree, symbol, place):
        places.append(place.size)
        return descend(tree, symbol, place)

    text = np.append(np.tile(np.arange(1, 41), 100), 0)
    index = substring.FMIndex(text)
    ends = np.arange(substring.WINDOW, len(text))
    monkeypatch.setattr(substring.WaveletTree, "descend", counted)
    length, low, high = index.matching_statistics(text, ends)
    assert (length == substring.WINDOW).all() and (high - low >= 99).all()
    assert sum(places) <= 2 * 40 * substring.WINDOW


def test_a_batch_sends_the_words_of_a_segment_once(monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 1)
    text = " \n".join(f"w{n}" for n in range(30))
    texts = pa.array([text, "x " + text + " ", None, text])
    words = next(substring.words_of(texts.slice(0, 1)))
    anchors = np.unique(substring.segments(words)[0]).view(np.int64)
    batch = pa.record_batch(
        [
            pa.array([9, 4, 5, 7]),
            texts,
            pa.array([anchors.tolist()] * 4, pa.list_(pa.int64())),
            pa.array([1, 2, 3, 4]),
        ],
        names=["doc_id", "text", "anchors", "row"],
    )
    rows = pa.Table.from_batches(list(substring._emit_segments(iter([batch])))).to_pylist()
    placed = [r for r in rows if r["kind"] == 0]
    sent = [r for r in rows if r["kind"] == 1]
    assert {r["doc_id"] for r in placed} == {4, 7, 9}
    assert len({r["name"] for r in sent}) == len(sent) < len(placed)
    least = {}
    for r in placed:
        least[r["name"]] = min(least.get(r["name"], r["doc_id"]), r["doc_id"])
    own = text.split()
    for r in sent:
        assert r["doc_id"] == least[r["name"]]
        first = r["place"] - (r["doc_id"] == 4)
        if first >= 0:
            assert r["words"].decode().split(" ") == own[first : first + r["n"] + 12]
