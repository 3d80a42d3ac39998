import random

import numpy as np
import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from wafertide.llm import langid

from .helpers import AWKWARD, frame


def corpus(rng, n=120):
    kinds = {"xx": ["shan", "thori", "welda", "ing"], "yy": ["ção", "mente", "ñu", "que"], "zz": ["üng", "ßer", "schen", "keit"]}
    rows = []
    for i in range(n):
        lang = ["xx", "yy", "zz"][i % 3]
        rows.append((i, " ".join("".join(rng.choices(kinds[lang], k=3)) for _ in range(rng.randrange(20, 200))), lang, "s"))
    return rows


def test_held_out_accuracy_and_purity(spark):
    rows = corpus(random.Random(1))
    got = {r.doc_id: r for r in langid.identify(frame(spark, rows)).collect()}
    import zlib

    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert {r[0] for r in held} == {i for i, r in got.items() if r.held_out}
    assert all(got[r[0]].lang_pred == r[2] for r in held) and len(held) > 10
    assert all(0 <= r.score <= 1 for r in got.values())
    # labels of held-out rows never reach training: spoiling them changes nothing
    spoiled = [(i, t, "qq" if got[i].held_out else lang, s) for i, t, lang, s in rows]
    again = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(frame(spark, spoiled)).collect()}
    assert again == {i: (r.lang_pred, r.score) for i, r in got.items()}


def test_awkward_rows(spark):
    rows = corpus(random.Random(2), 60) + [(1000 + i, t) for i, (_, t) in enumerate(AWKWARD)] + [(None, "thori")]
    docs = frame(spark, rows).withColumn("score", F.lit("clash")).withColumn("held_out", F.lit(1))
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002, 1008):
        assert by[i].lang_pred == "und" and by[i].score == 0
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {1000, 1001, 1002, 1008}.isdisjoint({r.doc_id for r in kept.collect()})


def test_without_labels(spark):
    empty = langid.identify(frame(spark, []))
    assert empty.columns == ["doc_id", "held_out", "lang_pred", "score"] and empty.count() == 0
    unlabelled = langid.identify(frame(spark, [(1, "hello", None, "s", 5), (2, None, None, None, None)])).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_tables_equal_plain_convolution():
    cfg = langid.Settings(window=32, epochs=1)
    model = langid.fit([("a", "hello there my friend, how are you"), ("b", "ça va très bien, merci à vous tous")], cfg)
    x = np.random.default_rng(0).integers(0, 256, (5, 32)).astype(np.uint8)
    pooled = []
    for kernel, bias in zip(model.kernels, model.biases):
        w = len(kernel)
        conv = np.stack([sum(model.embed[x[:, p + i]] @ kernel[i] for i in range(w)) for p in range(32 - w + 1)], 1)
        pooled.append(conv.max(1) + bias)
    want = langid.softmax(np.tanh(np.concatenate(pooled, 1)) @ model.weight + model.bias)
    assert np.allclose(langid.Scorer(model).windows(x), want, atol=1e-5)


def test_windows_cover_whole_texts():
    texts = pa.array(["abc", None, "", "x" * 70])
    flat, off = langid.utf8(texts)
    x, row, real = langid.windows(flat, off, 32)
    assert real.tolist() == [3, 32, 32, 6] and row.tolist() == [0, 3, 3, 3]
    assert bytes(x[0][:4]) == b"abc\0" and bytes(x[3][:7]) == b"xxxxxx\0"


def test_gradients_equal_differences():
    """Each parameter's gradient against the finite difference of the weighted cross entropy."""
    cfg, rng = langid.Settings(window=12, widths=(2, 3), filters=3, embedding=2), np.random.default_rng(1)
    x, y, weight = rng.integers(0, 6, (5, 12)), np.array([0, 1, 2, 1, 0]), np.array([0.5, 1.0, 2.0])
    params = [rng.normal(size=s) for s in ((256, 2), (2, 2, 3), (3, 2, 3), (3,), (3,), (6, 3), (3,))]

    def loss():
        pooled = []
        for kernel, bias in zip(params[1:3], params[3:5]):
            conv = np.stack([sum(params[0][x[:, p + i]] @ kernel[i] for i in range(len(kernel))) for p in range(12 - len(kernel) + 1)], 1)
            pooled.append(conv.max(1) + bias)
        q = langid.softmax(np.tanh(np.concatenate(pooled, 1)) @ params[5] + params[6])
        return (-np.log(q[np.arange(5), y]) * weight[y]).mean()

    grads = langid.gradients(params, x, y, weight, cfg)
    for p, g in zip(params, grads):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(12)] if p is not params[0] else [(i, j) for i in range(6) for j in range(2)]:
            old, seen = p[at], []
            for step in (1e-6, -1e-6):
                p[at] = old + step
                seen.append(loss())
            p[at] = old
            assert abs(g[at] - (seen[0] - seen[1]) / 2e-6) < 1e-6


def test_many_labels_are_all_learned(spark):
    """Eighty languages of an alphabet each: none is left out, and documents of all of them stay."""
    rng, rows = random.Random(8), []
    for k in range(80):
        letters = [chr(0x4E00 + 40 * k + i) for i in range(30)]
        for i in range(14):
            rows.append((100 * k + i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30)), f"l{k:02d}", "s"))
    cfg = langid.Settings(epochs=12, filters=32)
    model = langid.fit(langid.sample(frame(spark, rows), cfg), cfg)
    assert len(model.langs) == 80
    kept = langid.keep_identified(frame(spark, rows), cfg=cfg)
    assert kept.count() >= 0.98 * len(rows)
    with pytest.raises(ValueError):
        langid.sample(frame(spark, rows), langid.Settings(most_langs=50))
