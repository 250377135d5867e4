import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, texts, sources=None):
    rows = [
        (i, text, "en", sources[i] if sources else f"s{i % 3}", len(text or ""))
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, blanks, nulls and a very long one."""
    rng = random.Random(3)
    words = [f"w{n}" for n in range(400)] + ["Über", "élan", "日本", "a"]
    pick = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [pick(rng.randint(30, 120)) for _ in range(12)]
    passage = pick(60)
    out = [None, "", " \n\t ", "one", "One", "one two three", "x " * 40, "\x0b\x0c"]
    for text in base:
        out.append(text)
        out.append(text)
        parts = text.split()
        parts[len(parts) // 2] = "changed"
        out.append(" ".join(parts))
        out.append(text.upper())
    out += [pick(20) + " " + passage + "\n" + pick(20) for _ in range(5)]
    long = pick(30_000)
    out += [long, long + " " + pick(50)]
    chain = base[0].split() * 2
    for k in range(6):
        out.append(" ".join(chain[k * 4 : k * 4 + 60]))
    return out
