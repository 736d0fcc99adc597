"""Fill-in-middle: secondary-sort assembly against whole strings."""

import hashlib
import random
import re

import pytest

from lodgeframe.llm import infill

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, **settings):
    text = text or ""
    units = UNITS.findall(text)
    marked = any(m in text for m in ("<P>", "<S>", "<M>"))
    form, a, b = infill.plan("null" if doc_id is None else str(doc_id), len(units), marked, **settings)
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    output = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    assert infill.restore(output, form) == text
    if form != "plain":
        assert infill.arrange(p, m, s, form) == output
    chars = (None, None) if form == "plain" else (len(p), len(m))
    return (None if doc_id is None else str(doc_id), len(units), form, *chars, sha(output), sha(text)), output


@pytest.mark.parametrize("piece_bytes", [1, 7, 1 << 15])
def test_digests_equal_whole_strings(spark, piece_bytes):
    rnd = random.Random(5)
    parts = ["é", "🙂x", "word", " ", "\n\t", "<", "<P", "M>", "<M", " ", "\x1c", "long" * 20]
    rows = [(i, "".join(rnd.choices(parts, k=rnd.randrange(40)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n "), (203, "with <S> inside"), (None, "no id here"), (7, rows[7][1]), (7, "another text of 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = infill.transform(docs, "doc_id", "text", fim_percent=100, piece_bytes=piece_bytes)
    got = sorted(map(tuple, infill.digests(pieces).collect()), key=repr)
    assert got == sorted((brute(i, t, fim_percent=100)[0] for i, t in rows), key=repr)
    outputs = sorted((r.doc_id or "", r.form, r.output) for r in infill.texts(pieces).collect())
    assert outputs == sorted((r[0] or "", r[2], o) for r, o in (brute(i, t, fim_percent=100) for i, t in rows))
    if piece_bytes == 7:
        assert max(len(r.data) for r in pieces.collect()) <= 80 + 3      # a piece is whole units, here of 80 bytes at most


def test_edges_and_shares(spark, edge_docs):
    rows = infill.digests(infill.transform(edge_docs, "doc_id", "text")).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted((brute(r.doc_id, r.text)[0] for r in edge_docs.collect()), key=repr)
    assert infill.digests(infill.transform(edge_docs.limit(0), "doc_id", "text")).count() == 0
    clash = edge_docs.selectExpr("doc_id", "text", "1 as row", "2 as place", "'x' as form", "'y' as data", "3 as n")
    assert infill.digests(infill.transform(clash, "doc_id", "text")).count() == len(rows)
    forms = [infill.plan(str(i), 9, False)[0] for i in range(4000)]
    assert abs(forms.count("plain") - 2000) < 150 and abs(forms.count("spm") - 1600) < 150
