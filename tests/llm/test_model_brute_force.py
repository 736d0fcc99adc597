"""Toxicity and quality scores against plain loops over words, filters and rows."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import cotrain, toxicity
from lodgeframe.llm import textscan as ts

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# -- toxicity ----------------------------------------------------------------------------


def slots(word: bytes) -> list[int]:
    """Rows of the embedding table of one word, each hashed as a text of its own."""
    def code(part):
        block = next(ts.blocks(pa.array([part], pa.binary())))
        return int(block.hashes(np.array([0]), np.array([len(part)]))[0])

    codes = [code(word)] + [(code(word[:p]) * int(ts.BASE) + p) % 2**64 for p in toxicity.PREFIXES]
    return [int(ts.mix(np.array([c], np.uint64))[0] % np.uint64(toxicity.SLOTS)) for c in codes]


def plain_logit(model, text):
    words = ALNUM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    vectors = [sum(model["table"][s].astype(float) for s in slots(w.encode())) for w in words]
    vectors += [np.zeros(toxicity.DIM)] * toxicity.WIDTHS[-1]
    pooled = []
    for width in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            weights = model[f"f{width}"][:, f].astype(float)
            pooled.append(max(sum(float(v @ weights[i * toxicity.DIM:(i + 1) * toxicity.DIM]) for i, v in enumerate(vectors[at:at + width]))
                              for at in range(len(vectors) - width + 1)))
    active = [max(p + b, 0.0) for p, b in zip(pooled, model["bias"].astype(float))]
    return sum(a * o for a, o in zip(active, model["out"].astype(float))) + float(model["out_bias"][0])


@pytest.mark.parametrize("block_words", [7, 1 << 16])
def test_logits_equal_plain_loops(monkeypatch, block_words):
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", block_words)
    rnd, model = random.Random(3), toxicity.initial()
    model["bias"] += 0.05
    texts = [" ".join(rnd.choices(["Größe", "bad", "badness", "x", "long" * 9, "Y2"], k=k)) for k in (0, 1, 2, 3, 6, 8, 25, 40)]
    texts += [None, "?!"]
    got = []
    for block in ts.blocks(pa.array(texts, pa.string())):
        got += toxicity.forward(model, *toxicity.word_slots(block)).tolist()
    assert np.allclose(got, [plain_logit(model, t) for t in texts], atol=1e-4)


def test_scores_equal_plain_loops(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 25)) + (["vile"] if i % 3 == 0 else [])), rnd.choice(["en", "de", None])) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(80)], "doc_id long, toxic int")
    fitted = toxicity.fit(docs, labels, "doc_id", "text", "lang", "toxic", F.col("_id") % 10 == 1)
    scored = toxicity.score_toxicity(docs, labels, held_out=F.col("_id") % 10 == 1).collect()
    for r in scored:
        z = fitted["a"] * plain_logit(fitted["model"], r.text) + fitted["c"]
        assert abs(r.toxic_score - 1 / (1 + math.exp(-z))) < 1e-4
        assert r.toxic_in_lang == (r.toxic_score >= fitted["thresholds"].get(r.lang or "", fitted["all"]))


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{'vile' if i % 2 else 'kind'} " + "word " * 50, "en") for i in range(40)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    sizes = []
    monkeypatch.setattr(toxicity, "train", lambda texts, y: sizes.append(len(texts)) or toxicity.initial())
    toxicity.fit(docs, labels, "doc_id", "text", "lang", "toxic", None)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 255 * 20)
    toxicity.fit(docs, labels, "doc_id", "text", "lang", "toxic", None)
    assert sizes == [32, 16]                                  # four of five rows learn


# -- quality -----------------------------------------------------------------------------


def fit_plain(x, y, start):
    """Ridge logistic regression by guarded Newton steps, row by row."""
    d, ridge = x.shape[1], [cotrain.RIDGE] * (x.shape[1] - 1) + [1e-6]
    w, best, best_loss = np.array(start, float), np.array(start, float), math.inf
    for _ in range(cotrain.STEPS):
        loss, g, h = 0.5 * sum(r * v * v for r, v in zip(ridge, w)), np.zeros(d), np.zeros((d, d))
        for row, label in zip(x, y):
            z = float(row @ w)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            loss += max(z, 0) + math.log1p(math.exp(-abs(z))) - label * z
            g += row * (label - p)
            h += np.outer(row, row) * p * (1 - p)
        if loss > best_loss:
            w = (w + best) / 2
            continue
        settled = best_loss - loss < 1e-4 * abs(loss)
        best, best_loss = w, loss
        move = np.linalg.solve(h + np.diag(ridge), g - np.array(ridge) * w)
        w = w + move * min(1.0, 4.0 / max(np.abs(move).max(), 1e-9))
        if settled:
            break
    return best


def scale_plain(m):
    mean, spread = m.mean(axis=0), m.std(axis=0)
    mean[-1], spread[-1] = 0.0, 1.0
    return np.clip((m - mean) / np.where(spread < 1e-9, 1.0, spread), -8, 8)


def margins_plain(z, y):
    """Lowest and highest rounded margin from which a view was right often enough."""
    known = [(round_half_up(v * 4), t) for v, t in zip(z, y) if t is not None]
    low, high = -math.inf, math.inf
    for edge in sorted({b for b, _ in known}):
        above, below = [t for b, t in known if b >= edge], [t for b, t in known if b <= edge]
        if len(above) >= cotrain.SURE_ROWS and sum(above) >= cotrain.PRECISION * len(above):
            high = min(high, edge / 4)
        if len(below) >= cotrain.SURE_ROWS and len(below) - sum(below) >= cotrain.PRECISION * len(below):
            low = max(low, edge / 4)
    return low, high


def round_half_up(v):
    return math.floor(abs(v) + 0.5) * (1 if v >= 0 else -1)


def test_quality_equals_plain_co_training(spark):
    rnd = random.Random(6)
    def text(good):
        words = rnd.choices(["the", "river", "runs", "Slowly", "past", "old", "towns,"], k=rnd.randrange(20, 60))
        return " ".join(words) + "." if good else " ".join(w.upper() + rnd.choice(["!!!", "$$", "#"]) for w in words[:12])
    truth = {i: int(rnd.random() < 0.5) for i in range(400)}
    noise = lambda i, p: truth[i] if rnd.random() < p else 1 - truth[i]
    rows = [(i, text(noise(i, 0.99)), "news" if noise(i, 0.97) else "spam", "en", 100 * (1 + 3 * truth[i])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = {i: truth[i] for i in range(320)}
    got = {r.doc_id: r for r in cotrain.score_quality(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int")).collect()}

    y = [labels.get(i) for i in range(400)]
    views = {"content": cotrain.content(pa.array([r[1] for r in rows])),
             "metadata": cotrain.metadata(pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows]), pa.array([r[4] for r in rows], pa.int64()))}
    x = {name: scale_plain(m.astype(np.float32).astype(float)) for name, m in views.items()}
    train = lambda name, target, start: fit_plain(*zip_known(x[name], target), start)

    def zip_known(m, target):
        keep = [i for i, t in enumerate(target) if t is not None]
        return m[keep], [target[i] for i in keep]

    w = {name: train(name, y, np.zeros(m.shape[1])) for name, m in x.items()}
    handed = 0
    for _ in range(cotrain.ROUNDS):
        given = {}
        for name in x:
            z = x[name] @ w[name]
            low, high = margins_plain(z, y)
            given[name] = [t if t is not None else 0 if v <= low else 1 if v >= high else None for v, t in zip(z, y)]
            handed += sum(t is None and g is not None for t, g in zip(y, given[name]))
        w = {name: train(name, given[other], w[name]) for name, other in (("content", "metadata"), ("metadata", "content"))}
    z = {name: x[name] @ w[name] for name in x}
    both = np.stack([z["content"], z["metadata"], np.ones(400)], axis=1)
    mix = fit_plain(*zip_known(both, y), [1.0, 0.0, 0.0])
    assert handed > 50
    for i in range(400):
        for column, logit in (("content_score", z["content"][i]), ("metadata_score", z["metadata"][i]), ("quality_score", both[i] @ mix)):
            assert abs(got[i][column] - cotrain.sigmoid(np.array(logit))) < 1e-4, (i, column)


def test_pseudo_labels_are_reported(spark):
    rows = spark.createDataFrame([(k % 2, [float(k % 2), 1.0], [float(k % 2), 1.0]) for k in range(200)]
                                 + [(None, [3.0, 1.0], [-2.0, 1.0])] * 5, "label int, content array<float>, metadata array<float>")
    model = cotrain.train(rows, sure_rows=20)
    assert [(r["round"], r["view"]) for r in model["report"]] == [(k, v) for k in range(cotrain.ROUNDS) for v in ("content", "metadata")]
    assert model["report"][0]["good"] == 5 and model["report"][1]["bad"] == 5
    assert all(r["bad"] + r["good"] == 0 for r in cotrain.train(rows, sure_rows=1000)["report"])
