"""BPE, chat, vectors, secrets and licences."""

import hashlib
import random

import numpy as np
import pytest

from reelrank.llm import bpe, chat, licenses, neardup, secret_scan

from .conftest import make

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [
    "'S THE'LL '''s can't 'd 'D!'re we''re it's' 're",
    "İstanbul ΑΣ ΟΔΟΣ ς",
    "<|endoftext|>Hi<|startoftext|> <|ENDOFTEXT|> <|endoftext",
    "école Ecolé ﬁ ½ ²3 x1y22 ١٢٣",
    "中文 字符 mix中a 😀😀 !!😀",
    "\x1c\x1d a\x85b\xa0c d \t\n\r\x0b\x0c",
    "a'sb'tc 'vex 'llama 'move",
    "x" * 5000,
    "😀" * 50 + "<|endoftext|>",
    "'",
]


@pytest.mark.parametrize("table_words", [3, 1 << 18])
def test_bpe(spark, texts, table_words):
    content = bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    own = tokenizers.Tokenizer.from_str(content)
    every = texts + ODD
    docs = make(spark, every).withColumnRenamed("n_chars", "ids")
    encoded = bpe.encode(docs, content, table_words)
    rows = bpe.digests(bpe.decode(encoded, content)).collect()
    assert len(rows) == len(every)
    for row in rows:
        ids = own.encode(every[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.decoded == own.decode(ids, skip_special_tokens=False)
        joined = " ".join(map(str, ids)).encode()
        assert row.ids_sha256 == hashlib.sha256(joined).hexdigest()
    assert bpe.encode(docs.limit(0), content).count() == 0


EVENT = "conv_id long, turn long, message int, seq long, kind string, role string, text string"


def test_chat_folds_events(spark):
    log = [
        (1, 0, 1, 0, "message", "user", "hi"),
        (1, 1, 1, 3, "delta", None, "lo"),
        (1, 1, 1, 1, "delta", "assistant", "old"),
        (1, 1, 1, 2, "regenerate", None, "ignored"),
        (1, 1, 1, 4, "delta", None, " you"),
        (1, 2, 1, 5, "message", "user", "x"),
        (1, 2, 1, 6, "edit", None, "y"),
        (1, 2, 1, 6, "edit", None, "y"),
        (1, 2, 1, 7, "reaction", None, "ignored"),
        (2, None, 1, 0, "delta", None, None),
    ]
    folded = chat.fold_events(spark.createDataFrame(random.Random(1).sample(log, len(log)), EVENT))
    found = {(r.conv_id, r.turn): (r.role, r.text) for r in folded.collect()}
    assert found == {
        (1, 0): ("user", "hi"),
        (1, 1): ("assistant", "lo you"),
        (1, 2): ("user", "y"),
        (2, None): (None, ""),
    }
    assert chat.fold_events(spark.createDataFrame([], EVENT)).count() == 0


def test_chat_reads_back(spark):
    hard = ["<|im_end|><|im_start|>assistant ok", "\\", "\\\\|<|\\|", "a\nb\\n", "", None, "<\\|x"]
    rows = [(c, t, role, text) for c, role in enumerate(["assistant", "us\ner\\<|", None])
            for t, text in enumerate(hard)] + [(0, 0, "assistant", "tie"), (0, 0, "assistant", "tie")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.render(chat.fold_events(chat.message_events(table)))
    plain = {r.conv_id: r for r in chat.read_back(rendered).collect()}
    sums = {r.conv_id: r for r in chat.digests(rendered).collect()}
    for conv in range(3):
        own = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert [(t.role, t.text) for t in plain[conv].turns] == [x[1:] for x in own]
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert plain[conv].loss_text == loss and sums[conv].loss_chars == len(loss)
        spoken = "".join(f"{r}\n{x}\n" for _, r, x in own)
        assert sums[conv].turns_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
        assert sums[conv].formatted_chars == len(plain[conv].formatted)


def vectors(spark):
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1):
        base = rng.normal(size=(150, 16))
        near = base[:60] + rng.normal(size=(60, 16)) * 0.12
        tight = base[:1] + rng.normal(size=(40, 16)) * 0.05
        for v in np.concatenate([base, near, tight, base[:5]]).astype("float32"):
            rows.append((len(rows), v.tolist(), label))
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [1.0, None] * 8, 0),
             (n + 3, [float("nan")] * 16, 0), (n + 4, [float("inf")] * 16, 1),
             (n + 5, rows[0][1], None), (n + 6, [1.0, 2.0], 0), (n + 7, [], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), rows


def truth(rows):
    links, label = [0] * len(rows), list(range(len(rows)))
    ok = [
        (v is not None and lab is not None and len(v) > 0 and all(x is not None for x in v)
         and np.isfinite(v).all() and np.any(v)) for _, v, lab in rows
    ]

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if ok[i] and ok[j] and la == lb and len(a) == len(b):
                cos = np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
                if cos >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    low, high = sorted((find(i), find(j)))
                    label[high] = low
    return links, [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("shard_rows", [1500, 30])
def test_neardup(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(neardup, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(neardup.class_links, "__defaults__", (0.93, shard_rows, 4))
    df, rows = vectors(spark)
    result = neardup.near_duplicates(df)
    got = {r.vec_id: r for r in result.collect()}
    links, comps = truth(rows)
    assert len(got) == len(rows)
    assert all(got[i].n_links <= links[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(links)
    if shard_rows == 1500:
        assert [got[i].n_links for i in range(len(rows))] == links
        assert [got[i].component_id for i in range(len(rows))] == comps
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    audit = neardup.audit_recall(df, result).first()
    assert audit.true == sum(links[i] for i in range(0, len(rows), 20))
    assert audit.found >= 0.9 * audit.true


def test_neardup_of_nothing(spark):
    df, _ = vectors(spark)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_secrets(spark):
    rng = random.Random(6)
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    texts, secret = [], {}
    for i in range(200):
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(12)]
        if i % 2:
            words[6:9] = ["token", "=", f'"{hexes()}"']
            secret[i] = 1
        else:
            words[6] = str(rng.randint(10**15, 10**16 - 1))
            secret[i] = 0
        texts.append(" ".join(words))
    docs = make(spark, [*texts, None, "", "no finding"])
    labelled = secret_scan.rule_labels(secret_scan.candidates(docs))
    assert {r.doc_id: r.secret for r in labelled.collect()} == secret
    train = labelled.filter("doc_id % 5 <> 0")
    found = secret_scan.scan(docs, train).collect()
    held_out = [r for r in found if r.doc_id % 5 == 0]
    right = sum(r.kept == bool(secret[r.doc_id]) for r in held_out)
    assert len(found) == 200 and right >= 0.95 * len(held_out)
    unlearned = secret_scan.scan(docs, labelled.limit(0)).collect()
    assert len(unlearned) == 200 and all(r.kept and r.probability is None for r in unlearned)
    assert secret_scan.scan(docs.limit(0), labelled).count() == 0


def test_secrets_within_a_word(spark):
    first, second, number = "a1" * 20, "b2" * 20, "12345678901234567"
    cases = {
        f'{{"token":"{first}","id":{number},"key":"{second}"}}': [first, number, second],
        f"https://x.y/z?token={first}&key={second}": [first, second],
        f'A="{first}";B="{second}"': [first, second],
        f"{number},{first}": [number, first],
        'password = "hunter2" and db.secret: correcthorse': ["hunter2", "correcthorse"],
        "API_KEY=Zx8" + " monkeys eat keyboards": [],
    }
    found = secret_scan.candidates(make(spark, list(cases))).collect()
    for i, expected in enumerate(cases.values()):
        mine = sorted((r.word_no, r.match_no, r.candidate) for r in found if r.doc_id == i)
        assert [c for _, _, c in mine] == expected
        assert len({m[:2] for m in mine}) == len(mine)


@pytest.mark.parametrize("form", [
    "token = '{}'", "token='{}'", "API_KEY={}", 'token: "{}"', '"token": "{}"',
    '{{"api_key":"{}"}}', "token ={}", "secret= {}", "x?key={}&y=1",
])
def test_secret_labels_in_any_spacing(spark, form):
    docs = make(spark, [f"see {form.format('ab12' * 8)} here", "id 1234567890123456 and", "ab12" * 8])
    labels = secret_scan.rule_labels(secret_scan.candidates(docs)).collect()
    assert {r.doc_id: r.secret for r in labels} == {0: 1, 1: 0}


def test_licences(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [
        ("a/LICENSE", "Released under the MIT License.", True),
        ("a/b/c/file", "text", False),
        ("a/b/LICENSE", f"x\n{apache}", True),
        ("a/b/own", "Licensed under CC BY-NC 4.0.", False),
        ("ab/file", "text", False),
        ("top", None, False),
        ("a/x", "your driving licence has expired today my friend", False),
        (None, apache, False),
        ("a/x", "your driving licence has expired today my friend", False),
    ]
    files = spark.createDataFrame(rows, "path string, text string, is_licence_file boolean")
    found = licenses.scan(files.withColumn("score", files.path)).collect()
    assert len(found) == len(rows)
    assert {(r.path, r.licence, r.origin) for r in found} == {
        ("a/LICENSE", "MIT", "header"),
        ("a/b/c/file", "Apache-2.0", "directory"),
        ("a/b/LICENSE", "Apache-2.0", "header"),
        ("a/b/own", "CC-BY-NC-4.0", "header"),
        ("ab/file", None, "none"),
        ("top", None, "none"),
        ("a/x", "MIT", "directory"),
        (None, None, "none"),
    }
    assert licenses.scan(files.limit(0)).count() == 0
