"""Decontamination, subwords, substring dedup, Jaccard join and language model
against brute force on small tables, and on edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import ctw, decontam, jaccard_join, subwords, suffix_levels
from lodgeframe.llm import textscan as ts

NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


# -- decontamination ---------------------------------------------------------------------


def brute_hits(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows[m, tuple(w[k:k + m])].add(str(i))
    out = []
    for i, t in docs:
        w = ALNUM.findall(lower(t))
        hit, found = [0] * len(w), set()
        for m in {m for m, _ in windows}:
            for k in range(len(w) - m + 1):
                if (names := windows.get((m, tuple(w[k:k + m])))):
                    found |= names
                    hit[k:k + m] = [1] * m
        out.append((i, len(w), sum(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([3, 9, 10, 14])))) for i in range(12)] + [(12, None), (13, "!?"), (3, "w1 w2")]
    docs = [(i, " ".join(rnd.choices(words, k=30) + (rnd.choice(items)[1] or "").upper().split() + rnd.choices(words, k=5))) for i in range(60)]
    docs += [(60, None), (61, ""), (1, docs[1][1])]
    got = decontam.find_hits(spark.createDataFrame(docs, "doc_id long, text string"), "text",
                             spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", block_bytes=block_bytes).collect()
    rows = [(r.doc_id, r.n_words, sum(r.hit_words[1::2]) - sum(r.hit_words[::2]), r.hit_items) for r in got]
    assert sorted(rows, key=repr) == brute_hits(docs, items)


def test_decontamination_cuts_spans_and_drops_documents(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"Before é. {item.title()}! After."), (2, "clean text"), (3, None)], "doc_id long, text string")
    hits = decontam.find_hits(docs, "text", spark.createDataFrame([(7, item)], "item_id long, text string"), "item_id", "text")
    assert [r.text for r in decontam.remove_spans(hits, "text").orderBy("doc_id").collect()] == ["Before é. ! After.", "clean text", None]
    assert [r.doc_id for r in decontam.remove_documents(hits, docs.columns).orderBy("doc_id").collect()] == [2, 3]


def test_decontamination_edges(spark, edge_docs):
    items = spark.createDataFrame([(None, "alpha beta")], "item_id long, text string")
    rows = decontam.find_hits(edge_docs, "text", items, "item_id", "text").collect()
    assert len(rows) == 9 and [r.hit_items for r in rows if r.doc_id == 1] == [["null"], ["null"]]
    assert decontam.find_hits(edge_docs.limit(0), "text", items, "item_id", "text").count() == 0
    assert decontam.find_hits(edge_docs, "text", items.limit(0), "item_id", "text").where("size(hit_items) > 0").count() == 0


# -- subwords ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return subwords.Subwords(subwords.read_model(subwords.load(subwords.MODEL)))


def test_segmentation_has_the_largest_score(model):
    pieces = subwords.read_model(subwords.load(subwords.MODEL))["pieces"]
    score = {t: s for t, s, kind in pieces if kind == subwords.NORMAL}
    rnd = random.Random(1)
    for _ in range(40):
        text = "".join(rnd.choice("the and ing éñ日\n  xyzQ.") for _ in range(rnd.randint(1, 25)))
        s = (" " + text).replace(" ", subwords.SPACE)
        best = [0.0] + [-math.inf] * len(s)
        for i in range(len(s)):
            best[i + 1] = max(best[i + 1], best[i] + model.unknown)
            for n in range(1, min(model.longest, len(s) - i) + 1):
                if s[i:i + n] in score:
                    best[i + n] = max(best[i + n], best[i] + score[s[i:i + n]])
        ids, offsets = model.encode([text], {})
        unknown = sum(c not in score for c in s)
        got = sum(pieces[i][1] for i in ids if pieces[i][2] == subwords.NORMAL) + unknown * model.unknown
        assert got == best[-1]
        assert model.decode(ids, offsets) == [text]


def test_piece_inventory_equals_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=subwords.MODEL)
    text = "The cat sat on a mat, été 日本 \t x."
    ids, offsets = model.encode([text], {})
    assert library.decode([int(i) for i in ids]) == text and model.decode(np.array(library.encode(text)), np.array([0, len(library.encode(text))])) == [text]


def test_encoding_is_exact_on_edges(spark, edge_docs):
    rows = subwords.encode(edge_docs, "text").collect()
    assert len(rows) == 9 and all(r.decoded == r.text for r in rows)
    assert [r.ids for r in rows if r.doc_id == 2] == [None] and [r.ids for r in rows if r.doc_id == 3] == [[]]
    assert subwords.encode(edge_docs.limit(0), "text").count() == 0


def test_memory_of_units_may_be_forgotten(model, monkeypatch):
    monkeypatch.setattr(subwords, "MEMORY", 3)
    memory = {}
    for text in ("one two three", "four five six seven", "one ▁two", "eight"):
        assert model.decode(*model.encode([text], memory)) == [text]


# -- substring dedup ---------------------------------------------------------------------


def brute_repeats(texts, span):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + span] for b in data for p in range(len(b) - span + 1))
    out = []
    for b in data:
        covered = np.zeros(len(b), bool)
        for p in range(len(b) - span + 1):
            if seen[b[p:p + span]] > 1:
                covered[p:p + span] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
        out.append(edge.tolist())
    return out


def test_repeated_ranges_equal_brute_force(spark):
    rnd = random.Random(8)
    text = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    shared = [text(n) for n in (180, 198, 210, 350, 900)]
    rows = []
    for i in range(60):
        t = text(rnd.randint(0, 500)) + rnd.choice(shared) + text(rnd.randint(0, 300)) + (rnd.choice(shared) if i % 3 else "")
        if i % 7 == 0:                              # near copies
            t = rows[0][1][:400] + "Z" + rows[0][1][400:] if rows else t
        rows.append((i, t))
    rows += [(60, None), (61, ""), (62, "ab" * 400), (63, "q" * 199), (64, "r" * 201), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.text or "", r.repeats) for r in suffix_levels.repeated_ranges(df, "text").collect())
    want = sorted((i, t or "", r) for (i, t), r in zip(rows, brute_repeats([t for _, t in rows], 200)))
    assert got == want


def test_levels_merge_like_a_binary_counter(spark):
    docs = spark.createDataFrame([(i, f"{i} " + "".join(chr(97 + (i * j) % 26) for j in range(400))) for i in range(7)], "row long, text string")
    index = suffix_levels.SuffixLevels(4)
    sizes = []
    for i in range(5):
        index.insert(docs.where(F.col("row") == i))
        sizes.append(sorted(index.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2]]
    assert index.scan().agg(F.sum("places")).first()[0] == sum(a.where("places > 0").agg(F.sum("places")).first()[0] or 0 for a in index.arrays)


def test_repeats_on_edges(spark, edge_docs):
    rows = suffix_levels.repeated_ranges(edge_docs, "text").collect()
    assert len(rows) == 9 and [r.repeats for r in rows if r.doc_id == 7] == [[0, 70000]]
    assert [c for c in suffix_levels.remove_repeats(edge_docs, "text").columns] == edge_docs.columns
    assert suffix_levels.repeated_ranges(edge_docs.limit(0), "text").count() == 0


# -- Jaccard join ------------------------------------------------------------------------


def brute_components(docs, width, num, den):
    sets = []
    for i, t in docs:
        w = NOT_SPACE.findall(lower(t))
        sets.append((i, frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])))
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and den * len(x & y) >= num * len(x | y):
                i, j = find(i), find(j)
                root[max(i, j)] = min(i, j)
    return {i: (len(s), find(i)) for i, s in sets}


def near_copies(rnd):
    words = [f"w{i}" for i in range(2000)]
    docs = []
    for size, n in ((90, 130), (30, 50), (20, 300)):
        center = rnd.choices(words, k=n)
        for _ in range(size):
            x = list(center)
            for _ in range(rnd.randint(0, n // 16)):
                x[rnd.randrange(n)] = rnd.choice(words)
            docs.append(" ".join(x))
    passage = rnd.choices(words, k=55)
    docs += [" ".join(rnd.choices(words, k=rnd.randint(5, 70)) + passage) for _ in range(40)]
    docs += [None, "", "one two", "ONE two", " \t\n", docs[0], docs[0]]
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("width, num", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, width, num):
    docs = near_copies(random.Random(width))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(df, "doc_id", "text", width, (num, 100)).collect()}
    assert got == brute_components(docs, width, num, 100)


def test_components_with_small_blocks(spark, monkeypatch):
    for name, value in (("BLOCK_CLASSES", 7), ("HUB_SHARE", 5), ("SHORT_LIST", 2)):
        monkeypatch.setattr(jaccard_join, name, value)
    docs = near_copies(random.Random(9))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(df, "doc_id", "text", 4, (85, 100)).collect()}
    assert got == brute_components(docs, 4, 85, 100)


def test_join_on_edges(spark, edge_docs):
    rows = jaccard_join.link_components(edge_docs, "doc_id", "text").collect()
    assert len(rows) == 9 and {(r.doc_id, r.component_id) for r in rows} == {(i, i) for i in (1, 2, 3, 4, None, 5, 6, 7)}
    kept = jaccard_join.keep_one(edge_docs, "doc_id", "text")
    assert kept.columns == edge_docs.columns and kept.count() == 8
    assert jaccard_join.link_components(edge_docs.limit(0), "doc_id", "text").count() == 0


# -- language model ----------------------------------------------------------------------


def test_scores_equal_the_exact_tree(spark):
    depth, end = 2, b"\xff"
    texts = [(0, "abab abra", False), (1, "Bra cé", False), (2, None, True), (3, "", False), (4, "abra zz", True), (5, "abab abra", False)]
    df = spark.createDataFrame(texts, "doc_id long, text string, h boolean").repartition(2)
    got = {r.doc_id: r for r in ctw.score_texts(df, "doc_id", "text", F.col("h"), depth=depth).collect()}
    n = defaultdict(lambda: [0, 0])

    def steps(t):
        s = end * depth + lower(t).encode() + end
        for i in range(depth, len(s)):
            for k in range(8):
                yield s[i - depth:i], (1 << k) | (s[i] >> (8 - k)), (s[i] >> (7 - k)) & 1

    nodes = set()
    for _, t, held in texts:
        for context, path, bit in steps(t):
            for d in range(depth + 1):
                nodes.add((context[depth - d:], path))
                if not held:
                    n[context[depth - d:], path][bit] += 1

    def log_kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi) if a + b else 0.0

    def log_w(context, path):
        e = log_kt(*n.get((context, path), (0, 0)))
        if len(context) == depth:
            return e
        below = sum(log_w(c, p) for c, p in nodes if p == path and len(c) == len(context) + 1 and c[1:] == context)
        return math.log(.5) + max(e, below) + math.log1p(math.exp(-abs(e - below)))

    def one(context, path, d=0):
        s = context[depth - d:]
        a, b = n.get((s, path), (0, 0))
        p = (b + .5) / (a + b + 1)
        if d == depth:
            return p
        beta = math.exp(math.log(.5) + log_kt(a, b) - log_w(s, path))
        return beta * p + (1 - beta) * one(context, path, d + 1)

    for i, t, _ in texts:
        want = sum(math.log10(one(c, p) if b else 1 - one(c, p)) for c, p, b in steps(t))
        assert abs(got[i].score - want) < 1e-7
    c = Counter(w for _, t, held in texts if not held for w in NOT_SPACE.findall(lower(t)))
    total, distinct = sum(c.values()) + 4, len(c) + 1
    value = lambda x: math.log10((x + .1) / (total + .1 * (distinct + 1)))
    for i, t, _ in texts:
        w = NOT_SPACE.findall(lower(t))
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w) + 1, sum(c[x] > 0 for x in w) + 1, total)
        assert abs(got[i].base_score - sum(value(c[x]) for x in w) - value(4)) < 1e-9


def test_chunks_do_not_change_scores(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["the", "cat", "sat", "on", "mats", "é"]) for _ in range(200)), i % 5 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h boolean").repartition(3)
    one, many = ({r.doc_id: r.score for r in ctw.score_texts(df, "doc_id", "text", F.col("h"), chunk_bytes=b).collect()} for b in (1 << 25, 1))
    assert one.keys() == many.keys() and all(abs(one[i] - many[i]) < 1e-9 for i in one)


def test_scores_on_edges(spark, edge_docs):
    rows = ctw.score_texts(edge_docs, "doc_id", "text", F.col("doc_id") == 5).collect()
    assert len(rows) == 9 and all(r.score < 0 and r.base_score < 0 for r in rows)
    assert all(r.score < 0 for r in ctw.score_texts(edge_docs, "doc_id", "text", F.lit(True)).collect())
    assert ctw.score_texts(edge_docs.limit(0), "doc_id", "text", F.lit(False)).count() == 0


# -- scanning ----------------------------------------------------------------------------


def test_words_and_hashes_do_not_depend_on_blocks():
    import pyarrow as pa

    texts = ["one two", "", "  three\tfour five", "é ü", "x" * 50, "two one"]
    for size in (1, 8, 1 << 20):
        found = []
        for b in ts.blocks(pa.array(texts), size):
            low = b.lower()
            begin, end, at = low.words(ts.NOT_SPACE)
            h = low.hashes(begin, end)
            found += [h[at[i]:at[i + 1]].tolist() for i in range(len(b))]
        assert [len(x) for x in found] == [2, 0, 3, 2, 1, 2] and found[0] == found[5][::-1]


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 99, 57)
    for w in (1, 5, 57):
        assert ts.sliding_min(x, w).tolist() == [min(x[i:i + w]) for i in range(58 - w)]
