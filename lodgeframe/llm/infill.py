"""Fill-in-middle transformation by secondary-sort assembly.

A text is cut into units (a word with the blanks before it; blanks at the end
are one unit) and, for the drawn share of documents, rearranged as prefix,
suffix and middle behind control strings. No task builds a rearranged text:

1. ``emit`` sends out pieces, runs of whole units of about ``PIECE_BYTES``
   (only a longer unit is cut inside), keyed by the row and the piece's place
   in the output;
2. ``assemble`` is the secondary sort (repartition by row, sort within the
   partitions by row and place): each task then reads every output in order,
   piece by piece, with one piece in memory;
3. ``digests`` streams the pieces into an incremental digest. From the output
   and its form alone it finds the segments again and keys each piece by its
   place in the text; the same partitions are sorted a second time, without a
   second shuffle, and digested as the restored text.

A long document is many pieces, copies of a document are rows of their own.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lodgeframe.llm import textscan as ts
from lodgeframe.llm.common import as_batch, prepare, shuffle_width, table, text_bytes

# fixed values of the output format
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80

PIECE_BYTES = 32 << 10

#: order of the segments in the output, with the control string before each
LAYOUT = {PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

PIECES = "row long, place long, doc_id string, form string, n long, prefix_chars long, middle_chars long, data binary"


def draw(key: str, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers of a document id."""
    code = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(code[i:i + 8], 16) for i in range(0, 32, 8)]


def plan(key: str, n: int, marked: bool, seed: int = SEED, fim_percent: int = FIM_PERCENT,
         spm_percent: int = SPM_PERCENT) -> tuple[str, int, int]:
    """(form, units before the middle, units before the suffix) of a text of ``n`` units."""
    a, b, c, d = draw(key, seed)
    if n == 0 or marked or c % 100 >= fim_percent:
        return PLAIN, 0, 0
    first, last = sorted((a % (n + 1), b % (n + 1)))
    return (SPM if d % 100 < spm_percent else PSM), first, last


def arrange(prefix: str, middle: str, suffix: str, form: str) -> str:
    """A whole output text from its segments."""
    if form == PLAIN:
        return prefix + middle + suffix
    return "".join(mark + (prefix, middle, suffix)[part] for mark, part in LAYOUT[form])


def restore(output: str, form: str) -> str:
    """The exact text behind an output text."""
    if form == PLAIN:
        return output
    found, rest = {}, output
    for (mark, part), (after, _) in itertools.pairwise((*LAYOUT[form], ("", -1))):
        rest = rest[len(mark):]
        cut = rest.index(after) if after else len(rest)
        found[part], rest = rest[:cut], rest[cut:]
    return found[0] + found[1] + found[2]


def unit_ends(block: ts.Block) -> tuple[np.ndarray, np.ndarray]:
    """(end of every unit, n+1 offsets of each document's units)."""
    _, end, offsets = block.words(ts.NOT_SPACE)
    last = np.zeros(len(block), np.int64)                       # end of the last word, or the text's start
    some = np.diff(offsets) > 0
    last[:] = block.starts[:-1]
    last[some] = end[offsets[1:][some] - 1]
    tails = block.starts[1:][last < block.starts[1:]]           # blanks at the end
    units = np.sort(np.concatenate([end, tails]))
    return units, np.concatenate([[0], np.cumsum(np.diff(offsets) + (last < block.starts[1:]))])


def cut(units: np.ndarray, begin: int, end: int, piece_bytes: int) -> list[tuple[int, int]]:
    """Pieces of the bytes [begin, end): whole units up to ``piece_bytes``."""
    out, units = [], units[(units > begin) & (units <= end)]
    while begin < end:
        k = int(np.searchsorted(units, begin + piece_bytes, side="right")) - 1
        stop = int(units[k]) if k >= 0 and units[k] > begin else min(begin + piece_bytes, end)
        out.append((begin, stop))
        begin = stop
    return out


def emit(docs: DataFrame, doc_id: str, text: str, seed: int = SEED, fim_percent: int = FIM_PERCENT,
         spm_percent: int = SPM_PERCENT, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The pieces of every output, keyed by row and place. Each document sends
    at least one piece, maybe an empty one; a segment's first piece starts with
    its control string."""
    names = [f.split()[0] for f in PIECES.split(", ")]

    def pieces(batch):
        rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for block in ts.blocks(batch.column(2)):
            data = block.data.tobytes()
            ends, offsets = unit_ends(block)
            heads = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])   # code points before each byte
            out = {name: [] for name in names}
            for i in range(len(block)):
                begin, end = int(block.starts[i]), int(block.starts[i + 1])
                units = ends[offsets[i]:offsets[i + 1]]
                marked = any(data.find(m.encode(), begin, end) >= 0 for m in (PREFIX, SUFFIX, MIDDLE))
                key = ids[block.first + i]
                form, a, b = plan("null" if key is None else key, len(units), marked, seed, fim_percent, spm_percent)
                p, m = (int(units[k - 1]) if k else begin for k in (a, b))
                segments = ((begin, p), (p, m), (m, end))
                chars = (None, None) if form == PLAIN else (int(heads[p] - heads[begin]), int(heads[m] - heads[p]))
                place = 0
                for mark, part in LAYOUT.get(form, (("", None),)):
                    lo, hi = (begin, end) if part is None else segments[part]
                    for k, (x, y) in enumerate(cut(units, lo, hi, piece_bytes) or [(lo, lo)]):
                        values = (rows[block.first + i], place, key, form, len(units), *chars,
                                  (mark.encode() if k == 0 else b"") + data[x:y])
                        for name, value in zip(names, values):
                            out[name].append(value)
                        place += 1
            yield out

    schema = StructType.fromDDL(PIECES)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for cols in pieces(batch):
                yield as_batch(cols, arrow)

    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("string").alias("doc_id"),
                        F.col(text).cast("string").alias("text"))
    return keyed.mapInArrow(run, schema)


def assemble(pieces: DataFrame, partitions: int) -> DataFrame:
    """Secondary sort: all pieces of a row in one partition, in output order."""
    return pieces.repartition(partitions, "row").sortWithinPartitions("row", "place")


def transform(docs: DataFrame, doc_id: str, text: str, **settings) -> DataFrame:
    """Every output as sorted pieces: (row, place, doc_id, form, n, prefix_chars,
    middle_chars, data), all pieces of a row one after the other.

    ``docs`` must give the same rows in the same order when a lost task runs
    again, as file scans do (stage the result of a shuffle first): rows are told
    apart by their place in the input, so repeated ids or rows stay separate.
    A null text is empty; a null id is drawn as the id ``null``; empty texts and
    texts with a control string keep the plain form; an empty table gives no
    pieces. Other columns are not read, whatever their names.
    """
    prepare(docs.sparkSession)
    width = shuffle_width(docs.sparkSession, text_bytes(docs, text))
    return assemble(emit(docs, doc_id, text, **settings), width)


def texts(pieces: DataFrame) -> DataFrame:
    """Whole output texts of sorted pieces: (doc_id, form, output). A text is
    put together in memory here, as any row with the text must be."""

    def join(batches):
        held, key = [], None
        for r in (r for b in batches for r in b.select(["row", "doc_id", "form", "data"]).to_pylist()):
            if key is not None and r["row"] != key[0]:
                yield as_batch({"doc_id": [key[1]], "form": [key[2]], "output": [b"".join(held).decode()]}, arrow)
                held = []
            key = (r["row"], r["doc_id"], r["form"])
            held.append(r["data"])
        if key is not None:
            yield as_batch({"doc_id": [key[1]], "form": [key[2]], "output": [b"".join(held).decode()]}, arrow)

    schema = StructType.fromDDL("doc_id string, form string, output string")
    arrow = to_arrow_schema(schema)
    return pieces.mapInArrow(join, schema)


def digests(pieces: DataFrame) -> DataFrame:
    """One row per document from sorted pieces: doc_id, n, form, prefix_chars,
    middle_chars, output_sha256, restored_sha256 (of the text rebuilt from the
    output pieces and the form only)."""
    found = StructType.fromDDL("row long, part int, place long, doc_id string, form string, n long, "
                               "prefix_chars long, middle_chars long, data binary")
    found_arrow = to_arrow_schema(found)
    marks = {form: {m.encode(): part for m, part in layout} for form, layout in LAYOUT.items()}

    def digest_output(batches):
        """Passes the pieces on with their segment; after the last one of a row
        its values and the output's digest, as part -1 (it sorts first)."""
        row, code, info, part = None, None, None, 0
        for batch in batches:
            c = {f: batch.column(f).to_pylist() for f in batch.schema.names}
            out = {f.name: [] for f in found}

            def add(*values):
                for name, value in zip(out, values):
                    out[name].append(value)

            for k, r in enumerate(c["row"]):
                if r != row:
                    if row is not None:
                        add(row, -1, 0, *info, code.digest())
                    row, code, part = r, hashlib.sha256(), 0
                    info = tuple(c[x][k] for x in ("doc_id", "form", "n", "prefix_chars", "middle_chars"))
                data = c["data"][k]
                code.update(data)
                mark = data[:3]
                if info[1] != PLAIN and mark in marks[info[1]]:   # such texts hold no control string of their own
                    part, data = marks[info[1]][mark], data[3:]
                add(r, part, c["place"][k], None, None, None, None, None, data)
            yield as_batch(out, found_arrow)
        if row is not None:
            out = {name: [v] for name, v in zip(found.names, (row, -1, 0, *info, code.digest()))}
            yield as_batch(out, found_arrow)

    result = StructType.fromDDL("doc_id string, n long, form string, prefix_chars long, middle_chars long, "
                                "output_sha256 string, restored_sha256 string")
    result_arrow = to_arrow_schema(result)

    def digest_text(batches):
        head, code = None, None
        for batch in batches:
            c = {f: batch.column(f).to_pylist() for f in batch.schema.names}
            out = {f.name: [] for f in result}
            for k, part in enumerate(c["part"]):
                if part < 0:
                    if head is not None:
                        finish(out, head, code)
                    head = {f: c[f][k] for f in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "data")}
                    code = hashlib.sha256()
                else:
                    code.update(c["data"][k])
            yield as_batch(out, result_arrow)
        if head is not None:
            out = {f.name: [] for f in result}
            finish(out, head, code)
            yield as_batch(out, result_arrow)

    def finish(out, head, code):
        for f in ("doc_id", "n", "form", "prefix_chars", "middle_chars"):
            out[f].append(head[f])
        out["output_sha256"].append(head["data"].hex())
        out["restored_sha256"].append(code.hexdigest())

    return (pieces.mapInArrow(digest_output, found).sortWithinPartitions("row", "part", "place")
                  .mapInArrow(digest_text, result))


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = digests(transform(docs, "doc_id", "text"))
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
