"""Toxicity scores from a convolutional text classifier trained in numpy.

A word's embedding is the sum of rows of one hashed table: for the word and for
its first 4, 5 and 6 bytes, so that unseen forms of a known stem are near it.
Filters of several widths slide over the words; each filter's largest response
in the text (max pooling) feeds a logistic output. Pooling over the whole text
makes a single toxic phrase count in a text of any length.

All labelled rows are learned from. The first ``SAMPLE`` of them (by id hash) give
the starting weights; where there are more, the rows are dealt by id hash into
groups of bounded size, each group goes on from the starting weights over its
rows, and the groups' moves are averaged. Scoring is one narrow pass over whole
texts with the weights broadcast (their size is fixed by the parameters). The
output is calibrated on all labelled rows that were set aside (a fifth); the
operator also reports a threshold for each language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, StringType, StructType

from lodgeframe.llm import textscan as ts
from lodgeframe.llm.common import crc_mod, fresh_names, map_batches, prepare, stage, table

#: most toxic and most other rows that the starting weights are learned from (a fifth of them calibrate)
SAMPLE = (2500, 3500)
#: bytes of their texts (16 bytes a word reach the driver); rows beyond it are left out of the sample
SAMPLE_BYTES = 64 << 20
#: bits for a labelled id, and most words of 64 bits, in the table that tells most rows without a label
ID_BITS = 8
ID_WORDS = 1 << 20
SLOTS = 1 << 17
DIM = 16
PREFIXES = (4, 5, 6)
WIDTHS = (1, 2, 3)
FILTERS = 12
#: rows, and bytes of their texts, that one group goes on with
GROUP_ROWS = 4000
GROUP_BYTES = 32 << 20
#: parts of one unit in which moves are summed, so that their order does not matter
UNIT = 1 << 30
#: logits of rows that were set aside are counted in steps of this size
LOGIT_STEP = 1 / 256
#: training steps and texts in each, whatever the size of the sample
STEPS = 1100
BATCH = 32
RATE = 0.15
#: words that one block of the scoring pass convolves
BLOCK_WORDS = 1 << 16
#: predicted toxic from this score
THRESHOLD = 0.7


def word_slots(block: ts.Block) -> tuple[np.ndarray, np.ndarray]:
    """(words x (1 + prefixes) rows of the embedding table, n+1 offsets)."""
    low = block.lower()
    begin, end, offsets = low.words(ts.ALNUM)
    columns = [low.hashes(begin, end)] + [low.hashes(begin, np.minimum(begin + p, end)) * ts.BASE + np.uint64(p) for p in PREFIXES]
    return np.stack([(ts.mix(h) % np.uint64(SLOTS)).astype(np.int32) for h in columns], axis=1), offsets


def initial() -> dict:
    rng = np.random.default_rng(11)
    out = {"table": rng.normal(0, 0.1, (SLOTS, DIM)).astype(np.float32), "bias": np.zeros(len(WIDTHS) * FILTERS, np.float32),
           "out": rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), "out_bias": np.zeros(1, np.float32)}
    for w in WIDTHS:
        out[f"f{w}"] = rng.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS)).astype(np.float32)
    return out


def respond(model: dict, words: np.ndarray, offsets: np.ndarray, ended: bool = True):
    """Max-pooled filter responses of texts (before the non-linearity), with the
    word each one comes from. Texts are followed by padding of zero vectors, so
    every text has a window of every width; without ``ended`` (a part of a text
    that goes on) windows do not reach into it."""
    n, pad = len(offsets) - 1, WIDTHS[-1]
    lengths = np.diff(offsets)
    starts = offsets[:-1] + pad * np.arange(n)
    x = np.zeros((offsets[-1] + pad * n, DIM), np.float32)
    at = np.arange(offsets[-1]) + pad * np.repeat(np.arange(n), lengths)
    for c in range(words.shape[1]):
        x[at] += model["table"][words[:, c]]
    pooled, source = [], []
    for w in WIDTHS:
        wide = np.concatenate([x[i:len(x) - w + 1 + i] for i in range(w)], axis=1)
        y = wide @ model[f"f{w}"]
        ends = np.append(starts[1:], len(x)) - w + 1 - (0 if ended else pad)
        best = np.empty((n, FILTERS), np.int64)
        for i in range(n):
            best[i] = starts[i] + y[starts[i]:max(ends[i], starts[i] + 1)].argmax(axis=0)
        pooled.append(np.take_along_axis(y, best, axis=0))
        source.append(best)
    return np.concatenate(pooled, axis=1), source, x, starts


def forward(model: dict, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Logits of texts; the words are convolved in blocks, the maxima of a text's
    blocks (which overlap by the widest filter) are combined."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    pooled = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
    i = 0
    while i < n:
        if lengths[i] > BLOCK_WORDS:
            step, parts = BLOCK_WORDS - WIDTHS[-1], []
            for a in range(offsets[i], offsets[i + 1], step):
                z = min(a + BLOCK_WORDS, offsets[i + 1])
                parts.append(respond(model, words[a:z], np.array([0, z - a]), z == offsets[i + 1])[0])
            pooled[i] = np.max(parts, axis=0)[0]
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_WORDS, side="right")) - 1)
        j = min(j, n)
        pooled[i:j] = respond(model, words[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[0]
        i = j
    return np.maximum(pooled + model["bias"], 0) @ model["out"] + model["out_bias"][0]


def train(texts: list[np.ndarray], labels: np.ndarray) -> dict:
    """Weights from texts (word slots) and 0/1 labels."""
    return descend(initial(), texts, labels, STEPS)


def descend(model: dict, texts: list[np.ndarray], labels: np.ndarray, steps: int) -> dict:
    """``model`` moved, in place, by texts and labels: Adagrad on the weighted log
    loss; of the embedding table only the rows behind a maximum change."""
    size = {k: np.full(v.shape[:1] if k == "table" else v.shape, 1e-3, np.float32) for k, v in model.items()}
    balance = np.where(labels == 1, len(labels) / max(1, 2 * labels.sum()), len(labels) / max(1, 2 * (1 - labels).sum()))
    rng = np.random.default_rng(5)
    columns = 1 + len(PREFIXES)

    def update(name: str, gradient: np.ndarray) -> None:
        size[name] += gradient * gradient
        model[name] -= RATE * 0.3 * gradient / np.sqrt(size[name])

    order = np.concatenate([rng.permutation(len(texts)) for _ in range(-(-steps * BATCH // len(texts)))])
    for step in range(steps):
        pick = order[step * BATCH:(step + 1) * BATCH]
        words = np.concatenate([texts[i] for i in pick])
        offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
        pooled, source, x, starts = respond(model, words, offsets)
        active = np.maximum(pooled + model["bias"], 0)
        logit = active @ model["out"] + model["out_bias"][0]
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[pick]) * balance[pick] / len(pick)
        back = np.outer(error, model["out"]) * (active > 0)
        rows, grads = [], []
        doc_of = lambda at: np.searchsorted(starts, at, side="right") - 1
        for k, w in enumerate(WIDTHS):
            f, g = model[f"f{w}"], back[:, k * FILTERS:(k + 1) * FILTERS]
            at = source[k]
            wide = np.concatenate([x[np.minimum(at + i, len(x) - 1)] for i in range(w)], axis=2)
            pull = np.einsum("nf,df->nfd", g, f)
            for i in range(w):
                d = doc_of(at)
                word = at + i - WIDTHS[-1] * d
                real = (word < offsets[d + 1]) & (g != 0)
                move = pull[:, :, i * DIM:(i + 1) * DIM][real]
                for c in range(columns):
                    rows.append(words[word[real], c])
                    grads.append(move)
            update(f"f{w}", np.einsum("nfd,nf->df", wide, g))
        update("out", active.T @ error)
        update("out_bias", np.array([error.sum()]))
        update("bias", back.sum(axis=0))
        rows, grads = np.concatenate(rows), np.concatenate(grads)
        touched, at = np.unique(rows, return_inverse=True)
        total = np.zeros((len(touched), DIM), np.float32)
        np.add.at(total, at, grads)
        size["table"][touched] += (total * total).mean(axis=1)
        model["table"][touched] -= RATE * total / np.sqrt(size["table"][touched])[:, None]
    return model


def calibrate(logits: np.ndarray, labels: np.ndarray, prior: float, counts: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the labels (each occurring ``counts``
    times), weighted to the toxic share ``prior`` of all labelled rows."""
    a, c = 1.0, 0.0
    share = np.average(labels, weights=counts)
    weight = np.where(labels == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9)) * (1 if counts is None else counts)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * logits + c, -30, 30)))
        g = np.array([((labels - p) * weight * logits).sum() - 0.01 * (a - 1), ((labels - p) * weight).sum() - 0.01 * c])
        v = p * (1 - p) * weight
        h = np.array([[(v * logits**2).sum() + 0.01, (v * logits).sum()], [(v * logits).sum(), v.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, c = a + np.clip(step[0], -1, 1), c + np.clip(step[1], -2, 2)
    return max(float(a), 1e-3), float(c)


def best_threshold(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The score from which the F1 of the label is largest (0.5 without toxic rows)."""
    if not labels.sum():
        return 0.5
    counts = np.ones(len(labels), np.int64) if counts is None else counts
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum((labels * counts)[order])
    f1 = 2 * hits / (np.cumsum(counts[order]) + hits[-1])
    f1[:-1][scores[order][:-1] == scores[order][1:]] = 0
    k = int(f1.argmax())
    below = scores[order][k + 1] if k + 1 < len(order) else 0.0
    return float((scores[order][k] + below) / 2)


def slots_of(batch):
    """Word slots of a batch's texts (column 1) as binary, beside its other columns."""
    out = []
    for block in ts.blocks(batch.column(1)):
        words, offsets = word_slots(block)
        out += [words[offsets[i]:offsets[i + 1]].tobytes() for i in range(len(block))]
    yield {"label": batch.column(0), "slots": out, "lang": batch.column(2), "h": batch.column(3)}


def as_rows(model: dict) -> dict:
    """Every weight array as rows of ``DIM`` numbers."""
    return {k: np.pad(v.ravel(), (0, -v.size % DIM)).reshape(-1, DIM).astype(np.float64) for k, v in model.items()}


def go_on(rows: DataFrame, start: dict, n_rows: int, n_bytes: int) -> dict:
    """The starting weights moved by all ``rows`` (``h``, ``label``, ``text``): each
    group of them trains once over its rows; a row of weights moves by the mean of
    the groups that changed it."""
    groups = max(-(-n_rows // GROUP_ROWS), -(-n_bytes // GROUP_BYTES), 1)
    first = rows.sparkSession.sparkContext.broadcast(start)

    def moves(group):
        group = group.sort_by([("h", "ascending"), ("text", "ascending")])
        texts = []
        for block in ts.blocks(group["text"].combine_chunks()):
            words, offsets = word_slots(block)
            texts += [words[offsets[i]:offsets[i + 1]] for i in range(len(block))]
        model = descend({k: v.copy() for k, v in first.value.items()}, texts, group["label"].to_numpy().astype(np.float64), -(-len(texts) // BATCH))
        out, before = [], as_rows(first.value)
        for k, (name, after) in enumerate(as_rows(model).items()):
            move = np.rint((after - before[name]) * UNIT).astype(np.int64)
            at = np.flatnonzero(move.any(axis=1)) if name == "table" else np.arange(len(move))
            out.append(pa.table([np.full(len(at), k, np.int32), at.astype(np.int32), *move[at].T], schema=shape))
        return pa.concat_tables(out)

    values = [f"v{i}" for i in range(DIM)]
    shape = pa.schema([("part", pa.int32()), ("at", pa.int32()), *((v, pa.int64()) for v in values)])
    dealt = rows.select("h", "label", "text", F.pmod(F.xxhash64("h", F.lit(3)), F.lit(groups)).alias("part_of"))
    moved = dealt.groupBy("part_of").applyInArrow(moves, "part int, at int, " + ", ".join(f"{v} long" for v in values))
    got = moved.groupBy("part", "at").agg(*(F.sum(v).alias(v) for v in values), F.count(F.lit(1)).alias("n")).toArrow()   # as large as the weights
    out, part, at = as_rows(start), got["part"].to_numpy(), got["at"].to_numpy()
    mean = np.stack([got[v].to_numpy() for v in values], axis=1) / (got["n"].to_numpy()[:, None] * UNIT) if got.num_rows else np.zeros((0, DIM))
    for k, name in enumerate(start):
        out[name][at[part == k]] += mean[part == k]
        out[name] = out[name].ravel()[:start[name].size].reshape(start[name].shape).astype(np.float32)
    return out


def likely(rows: DataFrame, known: DataFrame, n_known: int) -> DataFrame:
    """``rows`` without most of those whose ``_id`` is not in ``known``: a broadcast
    table of bits tells them, so that their texts are not shuffled to an exact join
    that would drop them. Rows are kept whole where the ids differ in type."""
    kind = rows.schema["_id"].dataType
    if kind != known.schema["_id"].dataType or not isinstance(kind, (IntegralType, StringType)):
        return rows
    bits = 64 * min(ID_WORDS, max(1, -(-n_known * ID_BITS // 64)))
    bit = f"pmod(xxhash64(_id), {bits}L)"
    word, mask = F.expr(f"{bit} div 64").alias("_word"), f"shiftleft(1L, cast({bit} % 64 as int))"
    marks = known.select(word, F.expr(mask).alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_marks"))
    return (rows.withColumn("_word", word).join(F.broadcast(marks), "_word").where(F.expr(f"_marks & {mask}") != 0)
            .drop("_word", "_marks"))


def counted_logits(rows: DataFrame, model: dict):
    """Logits (in steps), labels, languages and counts of ``rows`` (``label``, ``text``, ``lang``)."""
    weights = rows.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        z = np.empty(batch.num_rows)
        for block in ts.blocks(batch.column(1)):
            z[block.first:block.first + len(block)] = forward(weights.value, *word_slots(block))
        yield {"label": batch.column(0), "lang": batch.column(2), "z": np.rint(np.clip(z, -60, 60) / LOGIT_STEP).astype(np.int32)}

    got = (map_batches(rows.select("label", "text", F.coalesce("lang", F.lit("")).alias("lang")), run, "label int, lang string, z int")
           .groupBy("lang", "label", "z").count().orderBy("lang", "label", "z").toArrow())
    return (got["z"].to_numpy() * LOGIT_STEP, got["label"].to_numpy().astype(np.float64), np.array(got["lang"].to_pylist(), object),
            got["count"].to_numpy())


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str, label: str, held_out: Column | None,
        sample: tuple[int, int] = SAMPLE) -> dict:
    """Model, calibration and thresholds from all labelled rows; the starting
    weights from those of smallest id hash (so nothing depends on the layout)."""
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("_id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label")))
    if held_out is not None:
        known = known.where(~F.coalesce(held_out, F.lit(False)))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return {}
    part = lambda y, n: known.where(F.col("label") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = part(1, sample[0]).union(part(0, sample[1]))
    order = [F.xxhash64("_id"), F.col("_id"), F.col("text")]
    texts_of = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = texts_of.join(F.broadcast(chosen), "_id").orderBy(*order).limit(sum(sample))
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)      # over the bounded sample
    rows = (rows.withColumn("bytes", F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(upto))
            .where(F.col("bytes") <= SAMPLE_BYTES).select("label", "text", "lang", F.xxhash64("_id").alias("h")))
    got = map_batches(rows, slots_of, "label int, slots binary, lang string, h long").toArrow()
    # counted by ids and lengths; the texts are shuffled once, and merged at every size
    lengths = texts_of.select("_id", F.octet_length("text").alias("n")).join(known.hint("merge"), "_id")
    total, size = lengths.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    everything = (likely(texts_of, known, counts[0] + counts[1]).join(known.hint("merge"), "_id")
                  .select(F.xxhash64("_id").alias("h"), "label", "text", "lang"))
    if not total:
        return {}
    texts = [np.frombuffer(x.as_py(), np.int32).reshape(-1, 1 + len(PREFIXES)) for x in got["slots"]]
    y = got["label"].to_numpy().astype(np.float64)
    aside = np.arange(len(y)) % 5 == 4
    learn = np.flatnonzero(~aside)
    model = train([texts[i] for i in learn], y[learn]) if len(learn) else initial()
    prior = counts[1] / (counts[0] + counts[1])
    if total > len(y):
        # rows of the sample keep their part in it; of the others, a fifth by hash is set aside
        h, later = got["h"].to_numpy(), F.pmod(F.xxhash64("h", F.lit(7)), F.lit(5)) == 4
        for k in (0, 1):
            if (y == k).any():
                mine = F.col("h").isin(h[aside & (y == k)].tolist())
                later = F.when((F.col("label") == k) & (F.col("h") <= int(h[y == k].max())), mine).otherwise(later)
        everything = stage(everything.withColumn("aside", later), "toxic_rows")
        model = go_on(everything.where(~F.col("aside")), model, total, size)
        logits, y, langs, n = counted_logits(everything.where("aside"), model)
        if not 0 < (y * n).sum() < n.sum():                        # too few rows to set any aside
            logits, y, langs, n = counted_logits(everything, model)
    else:
        check = np.flatnonzero(aside) if aside.any() and 0 < y[aside].sum() < aside.sum() else np.arange(len(y))
        logits = forward(model, np.concatenate([texts[i] for i in check]), np.concatenate([[0], np.cumsum([len(texts[i]) for i in check])]))
        logits, y, n = logits.astype(np.float64), y[check], np.ones(len(check), np.int64)
        langs = np.array([x or "" for x in got["lang"].to_pylist()], object)[check]
    a, c = calibrate(logits, y, prior, n)
    scores = 1 / (1 + np.exp(-np.clip(a * logits + c, -60, 60)))
    thresholds = {str(g): best_threshold(scores[langs == g], y[langs == g], n[langs == g]) for g in np.unique(langs)}
    return {"model": model, "a": a, "c": c, "prior": prior, "thresholds": thresholds, "all": best_threshold(scores, y, n)}


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                   label: str = "toxic", held_out: Column | None = None, sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """``docs`` with ``toxic_score`` (0 to 1, the calibrated probability),
    ``lang_threshold`` (that of the row's language; of all rows for languages
    not seen) and ``toxic_in_lang`` (score at or above it).

    The score depends on the text alone. Labels of ids where ``held_out`` (over
    the column ``_id``) is true are not learned from; a document with
    contradicting labels takes their majority (ties: toxic). Null and empty
    texts are scored by the model's response to no words; without labels of
    both kinds every score is 0.5. Repeated rows are scored each; an empty table
    gives an empty result; extra columns pass through (the three result names,
    if present, are replaced).
    """
    spark = docs.sparkSession
    prepare(spark)
    fitted = spark.sparkContext.broadcast(fit(docs, labels, doc_id, text, lang, label, held_out, sample))
    results = ("toxic_score", "lang_threshold", "toxic_in_lang")
    keep = [c for c in docs.columns if c.lower() not in results]

    def run(batch):
        f, n = fitted.value, batch.num_rows
        scores = np.full(n, 0.5)
        if f:
            for block in ts.blocks(batch.column(0)):
                z = forward(f["model"], *word_slots(block)).astype(np.float64)
                scores[block.first:block.first + len(block)] = 1 / (1 + np.exp(-np.clip(f["a"] * z + f["c"], -60, 60)))
        least = np.array([f["thresholds"].get(g or "", f["all"]) if f else 0.5 for g in batch.column(1).to_pylist()])
        yield {c: batch.column(2 + i) for i, c in enumerate(keep)} | {"toxic_score": scores, "lang_threshold": least,
                                                                      "toxic_in_lang": scores >= least}

    schema = StructType(list(docs.select(*keep).schema)).add("toxic_score", DoubleType()).add("lang_threshold", DoubleType()).add("toxic_in_lang", "boolean")
    body, tongue = fresh_names(docs.columns, "body", "tongue")
    return map_batches(docs.select(F.col(text).cast("string").alias(body), F.col(lang).cast("string").alias(tongue),
                                   *(f"`{c}`" for c in keep)), run, schema)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=crc_mod("_id", 3) == 1)
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"), "lang_threshold", "toxic_in_lang")
