"""Quality classifier by co-training on two views of a page.

The content view sees what the text looks like (character classes, words,
lines), the metadata view language, source and length. Each view is a logistic
regression. In every round each view labels, for the other, the unlabelled
documents it is sure about; how sure is read off the labelled rows (the smallest
margin from which it was right in ``PRECISION`` of the cases). After the rounds
a small logistic regression on the labelled rows combines the calibrated views,
and its probability scores all documents.

All documents take part in every round. A fit is a few Newton steps; a step is
one pass that sums the (d x d) normal equations by cell in Spark, so the driver
sees d^2 numbers whatever the number of tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructType

from lodgeframe.llm import textscan as ts
from lodgeframe.llm.common import as_batch, crc_mod, fresh_names, lists, map_batches, prepare, stage, table

ROUNDS = 2
STEPS = 7
RIDGE = 1.0
PRECISION = 0.98
#: labelled rows beyond a margin from which its precision counts; with fewer of one
#: class in all, a view hands over no pseudo-labels of that class (``report``)
SURE_ROWS = 50
#: a document stays if its probability of good quality reaches this
KEEP = 0.5

#: character classes counted in a text
CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": [32, 9, 13], "line": [10],
           "stop": b".,;:'\"()-", "shout": b"!?", "symbol": b"*#%&$@^~=+", "markup": b"|<>{}[]\\/_", "wide": range(128, 256)}
SOURCES, LANGS, LENGTHS = 64, 16, 12


def class_table() -> np.ndarray:
    out = np.full(256, len(CLASSES), np.int64)
    for i, members in enumerate(CLASSES.values()):
        out[list(members)] = i
    return out


def content(column: pa.Array) -> np.ndarray:
    """The content view: one row of numbers per text, and a constant."""
    classes, n_classes = class_table(), len(CLASSES) + 1
    not_line = np.ones(256, bool)
    not_line[10] = False
    out = []
    for b in ts.blocks(column):
        n = len(b)
        size = np.diff(b.starts)
        per = np.maximum(size, 1)[:, None]
        kind = classes[b.data]
        doc = np.repeat(np.arange(n), size)
        share = np.bincount(doc * n_classes + kind, minlength=n * n_classes).reshape(n, n_classes) / per
        begin, end, at = b.words(ts.NOT_SPACE)
        word = np.repeat(np.arange(n), np.diff(at))
        count = lambda of, mask=None: np.bincount(of if mask is None else of[mask], minlength=n)
        n_words = np.maximum(np.diff(at), 1)
        h, length = b.hashes(begin, end), end - begin
        sums = {k: np.concatenate([[0], np.cumsum(np.isin(kind, which))]) for k, which in
                (("upper", [0]), ("odd", [7, 8]), ("shout", [6]), ("letter", [0, 1, 9]))}
        inside = {k: s[end] - s[begin] for k, s in sums.items()}
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (word[1:] == word[:-1])
        words = np.stack([count(word, same), distinct(h, word, n), count(word, (inside["upper"] == length - inside["shout"]) & (length > 2)),
                          count(word, inside["odd"] > 0), count(word, inside["shout"] > 0), count(word, inside["letter"] == 0),
                          count(word, length <= 3), count(word, length > 12)], axis=1) / n_words[:, None]
        l_begin, l_end, l_at = b.words(not_line)
        line = np.repeat(np.arange(n), np.diff(l_at))
        n_lines = np.maximum(np.diff(l_at), 1)
        odd_lines = (sums["odd"][l_end] - sums["odd"][l_begin]) * 25 > l_end - l_begin
        loud_lines = (sums["upper"][l_end] - sums["upper"][l_begin]) * 2 > sums["letter"][l_end] - sums["letter"][l_begin]
        lines = np.stack([distinct(b.hashes(l_begin, l_end), line, n), count(line, odd_lines), count(line, loud_lines)], axis=1) / n_lines[:, None]
        sizes = np.stack([np.log1p(size), np.log1p(np.diff(at)), np.log1p(n_lines), size / n_words / 10], axis=1)
        x = np.concatenate([share, words, lines, sizes], axis=1)
        out.append(np.concatenate([x, np.sqrt(x), np.ones((n, 1))], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 1))


def distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each document."""
    _, first = np.unique(h ^ ts.mix(doc.astype(np.uint64)), return_index=True)
    return np.bincount(doc[first], minlength=n)


def metadata(source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """The metadata view: hashed one-hot source and language, length class, a constant."""
    n = len(source)
    out = np.zeros((n, SOURCES + LANGS + LENGTHS + 1))
    row, at = np.arange(n), 0
    for column, width in ((source, SOURCES), (lang, LANGS)):
        code = np.concatenate([b.hashes(b.starts[:-1], b.starts[1:]) for b in ts.blocks(column)] or [np.zeros(0, np.uint64)])
        out[row, at + (code % np.uint64(width)).astype(np.int64)] = 1
        at += width
    size = np.nan_to_num(n_chars.cast(pa.float64()).to_numpy(zero_copy_only=False), nan=0.0)
    out[row, at + np.clip(np.log2(np.maximum(size, 1)).astype(int) - 4, 0, LENGTHS - 1)] = 1
    out[:, -1] = 1
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Fit:
    """One logistic regression on its way: the array column ``x``, the column
    ``label`` (null: not used), the scale of ``x`` and the weights so far."""

    def __init__(self, x: str, label: str, scale: tuple, start: np.ndarray):
        self.x, self.label, self.scale, self.w = x, label, scale, start
        self.best, self.best_loss, self.done = start, np.inf, False
        self.ridge = np.full(len(start), RIDGE)
        self.ridge[-1] = 1e-6

    def step(self, sums: np.ndarray) -> None:
        """A guarded Newton step from Hessian, gradient and log loss at ``w``."""
        d = len(self.w)
        loss = sums[-1] + 0.5 * (self.ridge * self.w * self.w).sum()
        if loss > self.best_loss:            # overshot: go half way back
            self.w = (self.w + self.best) / 2
            return
        self.done = self.best_loss - loss < 1e-4 * abs(loss)
        self.best, self.best_loss = self.w, loss
        h, g = sums[:d * d].reshape(d, d), sums[d * d:-1]
        move = np.linalg.solve(h + np.diag(self.ridge), g - self.ridge * self.w)
        self.w = self.w + move * min(1.0, 4.0 / max(np.abs(move).max(), 1e-9))


def newton(rows: DataFrame, fits: list[Fit]) -> list[np.ndarray]:
    """Weights of some ridge logistic regressions over the same rows: at most
    ``STEPS`` steps, each one pass for all that have not settled."""
    for _ in range(STEPS):
        live = [f for f in fits if not f.done]
        if not live:
            break
        for f, sums in zip(live, normal_equations(rows, live)):
            f.step(sums)
    return [f.best for f in fits]


def normal_equations(rows: DataFrame, fits: list[Fit]) -> list[np.ndarray]:
    """Of each fit: Hessian, gradient and log loss at its weights, back to back."""
    parts = [(f.scale, f.w) for f in fits]
    sizes = [len(w) ** 2 + len(w) + 1 for _, w in parts]

    def run(batches):
        totals = [np.zeros(n) for n in sizes]
        for batch in batches:
            for i, (total, (scale, w)) in enumerate(zip(totals, parts)):
                d, y = len(w), batch.column(2 * i + 1).to_numpy(zero_copy_only=False).astype(float)
                known = ~np.isnan(y)
                m, y = scaled(matrix(batch.column(2 * i), d)[known], scale), y[known]
                z = m @ w
                p = sigmoid(z)
                total[-1] += (np.logaddexp(0, z) - y * z).sum()
                total[:d * d] += ((m * (p * (1 - p))[:, None]).T @ m).ravel()
                total[d * d:-1] += m.T @ (y - p)
        total = np.concatenate(totals)
        yield as_batch({"cell": np.arange(len(total)), "value": total}, schema)

    schema = pa.schema([("cell", pa.int64()), ("value", pa.float64())])
    labelled = F.coalesce(*(F.col(f.label) for f in fits)).isNotNull()
    columns = [c for i, f in enumerate(fits) for c in (F.col(f.x).alias(f"x{i}"), F.col(f.label).cast("double").alias(f"y{i}"))]
    found = (rows.where(labelled).select(columns).mapInArrow(run, "cell long, value double")
             .groupBy("cell").agg(F.sum("value").alias("value")).toPandas())
    out = np.zeros(sum(sizes))
    out[found["cell"].to_numpy()] = found["value"].to_numpy()
    return np.split(out, np.cumsum(sizes)[:-1])


def matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(float).reshape(-1, d)


def scaled(m: np.ndarray, scale: tuple) -> np.ndarray:
    return np.clip((m - scale[0]) / scale[1], -8, 8)


def moments(rows: DataFrame, x: str, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each column; the constant stays 1."""

    def run(batches):
        n, s, q = 0, np.zeros(d), np.zeros(d)
        for batch in batches:
            m = matrix(batch.column(0), d)
            n, s, q = n + len(m), s + m.sum(axis=0), q + (m * m).sum(axis=0)
        yield as_batch({"cell": np.arange(2 * d + 1), "value": np.concatenate([s, q, [n]])}, schema)

    schema = pa.schema([("cell", pa.int64()), ("value", pa.float64())])
    found = (rows.select(x).mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
             .orderBy("cell").toPandas()["value"].to_numpy())
    if not len(found):
        return np.zeros(d), np.ones(d)
    n = max(found[-1], 1)
    mean = found[:d] / n
    spread = np.sqrt(np.maximum(found[d:2 * d] / n - mean**2, 0))
    mean[-1], spread[-1] = 0.0, 1.0
    return mean, np.where(spread < 1e-9, 1.0, spread)


def with_scores(rows: DataFrame, views: dict) -> DataFrame:
    """``rows`` with each view's logit as ``z_<view>``."""

    def run(batch):
        cols = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        for name, (scale, w) in views.items():
            cols[f"z_{name}"] = scaled(matrix(cols[name], len(w)), scale) @ w
        yield cols

    schema = StructType(list(rows.schema))
    for name in views:
        schema = schema.add(f"z_{name}", "double")
    return map_batches(rows, run, schema)


def sure(scored: DataFrame, z: str, least: int = SURE_ROWS) -> tuple[float, float]:
    """Margins (for bad, for good) beyond which a view was right in ``PRECISION`` of
    at least ``least`` labelled rows; infinite if never."""
    bins = (scored.where("label is not null").groupBy(F.round(F.col(z).cast("double") * 4).alias("bin"))
            .agg(F.sum("label").alias("good"), F.count("*").alias("n")).orderBy("bin").toPandas())
    at, good, n = (bins[c].to_numpy(float) for c in ("bin", "good", "n"))
    up_good, up_n = good[::-1].cumsum()[::-1], n[::-1].cumsum()[::-1]
    down_bad, down_n = (n - good).cumsum(), n.cumsum()
    high = at[(up_good >= PRECISION * up_n) & (up_n >= least)]
    low = at[(down_bad >= PRECISION * down_n) & (down_n >= least)]
    return (low.max() / 4 if len(low) else -np.inf), (high.min() / 4 if len(high) else np.inf)


def train(rows: DataFrame, sure_rows: int = SURE_ROWS) -> dict:
    """Co-train on staged rows (label, content, metadata); returns the views'
    scales and weights, the combination, and ``report``: for each round and view
    the unlabelled rows it called bad and good, for the other view to learn from."""
    first = rows.first()
    if first is None or not rows.where("label is not null").limit(1).count():
        return {}
    scales = {name: moments(rows, name, len(first[name])) for name in ("content", "metadata")}
    fits = newton(rows, [Fit(name, "label", scale, np.zeros(len(scale[0]))) for name, scale in scales.items()])
    views = {name: (scales[name], w) for name, w in zip(scales, fits)}
    report = []
    for number in range(ROUNDS):
        scored = with_scores(rows, views)
        pseudo = {}
        for name in views:
            low, high = sure(scored, f"z_{name}", sure_rows)
            z = F.col(f"z_{name}")
            pseudo[name] = F.coalesce("label", F.when(z <= F.lit(float(low)), 0).when(z >= F.lit(float(high)), 1))
        shared = stage(scored.select("label", *views, *(pseudo[name].alias(f"by_{name}") for name in views)), "cotrain-round")
        given = shared.where("label is null").agg(*(F.count_if(F.col(f"by_{name}") == y).alias(f"{name}_{y}") for name in views for y in (0, 1))).first()
        report += [{"round": number, "view": name, "bad": given[f"{name}_0"], "good": given[f"{name}_1"]} for name in views]
        fits = newton(shared, [Fit(name, f"by_{other}", *views[name]) for name, other in (("content", "metadata"), ("metadata", "content"))])
        views = {name: (scales[name], w) for name, w in zip(scales, fits)}
    z = with_scores(rows.where("label is not null"), views)
    both = stage(z.select("label", F.array("z_content", "z_metadata", F.lit(1.0)).alias("z")), "cotrain-views")
    unit = (np.zeros(3), np.ones(3))
    return {"views": views, "mix": newton(both, [Fit("z", "label", unit, np.array([1.0, 0.0, 0.0]))])[0], "report": report}


def features(docs: DataFrame, text: str, source: str, lang: str, n_chars: str, extra: list[str]) -> DataFrame:
    def run(batch):
        a = content(batch.column(0))
        b = metadata(batch.column(1), batch.column(2), batch.column(3))
        cols = {c: batch.column(4 + i) for i, c in enumerate(extra)}
        for name, m in (("content", a), ("metadata", b)):
            cols[name] = lists(m.astype(np.float32).ravel(), np.arange(len(m) + 1) * m.shape[1], pa.float32())
        yield cols

    schema = StructType(list(docs.select(*extra).schema)).add("content", ArrayType(FloatType())).add("metadata", ArrayType(FloatType()))
    return map_batches(inputs(docs, text, source, lang, n_chars, extra), run, schema)


def inputs(docs: DataFrame, text: str, source: str, lang: str, n_chars: str, extra: list[str]) -> DataFrame:
    names = fresh_names(docs.columns, "in_text", "in_source", "in_lang", "in_n_chars")
    kinds = ("string", "string", "string", "double")
    return docs.select(*(F.col(c).cast(kind).alias(name) for c, kind, name in zip((text, source, lang, n_chars), kinds, names)), *extra)


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                  lang: str = "lang", n_chars: str = "n_chars", label: str = "quality", held_out: Column | None = None) -> DataFrame:
    """``docs`` with ``quality_score`` (probability of good quality),
    ``content_score`` and ``metadata_score`` (the views' own probabilities).

    Labels of rows where ``held_out`` is true are not learned from. A document
    with contradicting labels takes their majority (ties: good); null ids and
    null labels are unlabelled. Null or empty texts and null metadata have
    features of their own. Without any label all scores are 1 (nothing is
    known against a text). Repeated rows are scored each; an empty table gives
    an empty result; extra columns pass through (the three result names, if
    present, are replaced).
    """
    prepare(docs.sparkSession)
    usable = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id"))
              .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label")))
    if held_out is not None:
        usable = usable.where(~F.coalesce(held_out, F.lit(False)))
    named = docs.select(F.col(doc_id).alias("_id"), *(c for c in dict.fromkeys((text, source, lang, n_chars))))
    rows = stage(features(named, text, source, lang, n_chars, ["_id"]), "cotrain-features")
    rows = stage(rows.join(usable, "_id", "left").select("label", "content", "metadata"), "cotrain-rows")
    model = train(rows)
    results = ("quality_score", "content_score", "metadata_score")
    keep = [c for c in docs.columns if c.lower() not in results]

    def run(batch):
        cols = {c: batch.column(4 + i) for i, c in enumerate(keep)}
        n = batch.num_rows
        if model:
            ms = {"content": content(batch.column(0)), "metadata": metadata(batch.column(1), batch.column(2), batch.column(3))}
            z = {name: scaled(ms[name].astype(np.float32).astype(float), s) @ w for name, (s, w) in model["views"].items()}
            mix = model["mix"]
            scores = (sigmoid(z["content"] * mix[0] + z["metadata"] * mix[1] + mix[2]), sigmoid(z["content"]), sigmoid(z["metadata"]))
        else:
            scores = (np.ones(n),) * 3
        yield cols | dict(zip(results, scores))

    schema = StructType(list(docs.select(*keep).schema))
    for c in results:
        schema = schema.add(c, "double")
    return map_batches(inputs(docs, text, source, lang, n_chars, [f"`{c}`" for c in keep]), run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = KEEP) -> DataFrame:
    """The documents whose probability of good quality reaches ``least``."""
    return score_quality(docs, labels).where(F.col("quality_score") >= least).select(docs.columns)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("_id", 5) == 0
    scored = score_quality(docs, table(spark, sf_dir, "labels"), held_out=held_out)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= KEEP).cast("int").alias("keep"), "content_score", "metadata_score")
