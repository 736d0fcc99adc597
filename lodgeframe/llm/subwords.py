"""SentencePiece encoding and decoding with a batched numpy Viterbi search.

The pieces and scores come from a public ``.model`` file (a path; nothing is
trained). A text is normalised as the model's header says for identity rules:
a dummy space in front, every space written as U+2581. It is cut into units
that no piece crosses; the distinct units of a batch are grouped by length, and
all units of one length advance through the Viterbi lattice together: at each
position and piece length the hashes of their substrings probe the sorted piece
hashes, and a vectorised maximum stores score and backpointer. Characters
without a piece become their UTF-8 byte pieces. The segmentation has the largest
sum of scores; of equal sums, the one with the longer last piece, position by
position. Decoding is exact for every text.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from lodgeframe.llm import textscan as ts
from lodgeframe.llm.common import lists, map_batches, prepare, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: score of a character that has no piece, in addition to the lowest piece score
UNKNOWN = 10.0
#: largest model file
MODEL_BYTES = 64 << 20
#: distinct units remembered by a task
MEMORY = 1 << 20
NORMAL, UNKNOWN_KIND, CONTROL, BYTE = 1, 2, 3, 6


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 0x7F) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 0x80:
            return value, at


def fields(data: bytes):
    """(number, value) of a protobuf message's fields."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        if tag & 7 == 0:
            value, at = varint(data, at)
        elif tag & 7 == 2:
            n, at = varint(data, at)
            value, at = data[at:at + n], at + n
        else:
            n = 8 if tag & 7 == 1 else 4
            value, at = data[at:at + n], at + n
        yield tag >> 3, value


def read_model(data: bytes) -> dict:
    """Pieces (text, score, kind by id) and normaliser flags of a model file."""
    pieces, dummy, squeeze = [], True, True
    for number, value in fields(data):
        if number == 1:
            f = dict(fields(value))
            pieces.append((f.get(1, b"").decode(), float(np.frombuffer(f[2], "<f4")[0]) if 2 in f else 0.0, f.get(3, NORMAL)))
        elif number == 3:
            f = dict(fields(value))
            dummy, squeeze = bool(f.get(3, 1)), bool(f.get(4, 1))
    return {"pieces": pieces, "dummy_prefix": dummy, "squeeze": squeeze}


class Subwords:
    """Vectorised encoder and decoder for one model."""

    def __init__(self, model: dict):
        self.dummy, self.squeeze = model["dummy_prefix"], model["squeeze"]
        pieces = model["pieces"]
        normal = [i for i, (t, _, kind) in enumerate(pieces) if kind == NORMAL and t]
        self.byte_ids = np.zeros(256, np.int32)
        for i, (t, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_ids[int(t[1:-1], 16)] = i
        codes = [np.frombuffer(pieces[i][0].encode("utf-32-le"), np.uint32) for i in normal]
        size = np.array([len(c) for c in codes])
        self.longest = int(size.max()) if len(size) else 1
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        at = np.concatenate([[0], np.cumsum(size)])
        hashes = np.array([self.roll(flat[at[i]:at[i + 1]]) for i in range(len(codes))], np.uint64)
        self.by_size = {}
        for n in np.unique(size):
            pick = np.flatnonzero(size == n)
            pick = pick[np.argsort(hashes[pick])]
            self.by_size[int(n)] = (hashes[pick], np.array(normal, np.int32)[pick],
                                    np.array([pieces[normal[i]][1] for i in pick]), np.array([codes[i] for i in pick]))
        scores = [pieces[i][1] for i in normal]
        self.unknown = (min(scores) if scores else 0.0) - UNKNOWN
        # characters inside longer pieces; others, and the places before a run of spaces, cut a text
        inner = {c for code in codes if len(code) > 1 for c in code.tolist()}
        self.joined = "".join(chr(c) for c in sorted(inner))
        self.crosses = any(SPACE in pieces[i][0].lstrip(SPACE) for i in normal)
        # texts of the pieces as bytes, for decoding
        raw = [bytes([int(t[1:-1], 16)]) if kind == BYTE else b"" if kind in (CONTROL, UNKNOWN_KIND) else
               t.replace(SPACE, " ").encode() for t, _, kind in pieces]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])

    @staticmethod
    def roll(code: np.ndarray) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in code:
            h = h * ts.BASE + np.uint64(c) + np.uint64(1)
        return h[0]

    def pattern(self):
        """Regular expression of the units a normalised text is cut into."""
        joined = re.escape(self.joined.replace(SPACE, ""))
        if self.crosses:
            return re.compile(f"[{joined}{SPACE}]+|.", re.DOTALL)
        return re.compile(f"{SPACE}*[{joined}]+|{SPACE}+|.", re.DOTALL)

    def units(self, text: str, find) -> list[str]:
        """The units of a text. A U+2581 of the text itself is the unit '', which
        stands for its UTF-8 bytes, so it stays apart from a space."""
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if self.dummy and text:
            text = " " + text
        if SPACE not in text:
            return find(text.replace(" ", SPACE))
        out: list[str] = []
        for part in text.split(SPACE):
            out += [*find(part.replace(" ", SPACE)), ""]
        return out[:-1]

    def segment(self, units: list[str]) -> tuple[list[str], list[np.ndarray], list[np.ndarray]]:
        """(units by length, their pieces back to back, numbers of pieces); units
        of one length advance together."""
        length = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(length, kind="stable")
        ids, sizes = [], []
        for group in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
            n = int(length[group[0]])
            rows = max(1, 2_000_000 // (n + 1))
            for i in range(0, len(group), rows):
                part = group[i:i + rows]
                code = np.frombuffer("".join([units[j] for j in part]).encode("utf-32-le"), np.uint32).reshape(len(part), n)
                flat, size = self.viterbi(code)
                ids.append(flat)
                sizes.append(size)
        return [units[j] for j in order], ids, sizes

    def viterbi(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all rows back to back, number of each row's) for rows of code points."""
        rows, n = code.shape
        best = np.full((n + 1, rows), -np.inf)
        best[0] = 0.0
        size = np.ones((n + 1, rows), np.int32)          # of the last piece up to a position
        last = np.full((n + 1, rows), -1, np.int32)      # its id, -1: a character without piece
        for start in range(n):
            h = np.zeros(rows, np.uint64)
            base = best[start]
            alone = base + self.unknown
            better = alone > best[start + 1]
            best[start + 1] = np.where(better, alone, best[start + 1])
            size[start + 1][better], last[start + 1][better] = 1, -1
            for m in range(1, min(self.longest, n - start) + 1):
                h = h * ts.BASE + code[:, start + m - 1] + np.uint64(1)
                if m not in self.by_size:
                    continue
                hashes, ids, scores, texts = self.by_size[m]
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == h)
                hit = hit[(texts[at[hit]] == code[hit, start:start + m]).all(axis=1)]
                if not len(hit):
                    continue
                k = at[hit]
                value, end = base[hit] + scores[k], start + m
                win = value > best[end][hit]
                hit, k = hit[win], k[win]
                best[end][hit], size[end][hit], last[end][hit] = value[win], m, ids[k]
        # walk the backpointers of all rows together
        at, row = np.full(rows, n), np.arange(rows)
        steps, marks = [], []
        while (at > 0).any():
            live = at > 0
            steps.append(np.where(live, last[at, row], -2))
            marks.append(at.copy())
            at = np.where(live, at - size[at, row], 0)
        steps, marks = np.array(steps[::-1]).T, np.array(marks[::-1]).T
        use = steps != -2
        flat, sizes = steps[use].astype(np.int32), use.sum(axis=1)
        if (flat >= 0).all():
            return flat, sizes
        # characters without a piece: their UTF-8 bytes
        row = np.repeat(np.arange(rows), sizes)
        parts = [self.byte_ids[list(chr(int(code[r, end - 1])).encode())] if i < 0 else np.array([i], np.int32)
                 for i, r, end in zip(flat, row, marks[use])]
        return np.concatenate(parts), np.bincount(row, [len(x) for x in parts], minlength=rows).astype(np.int64)

    def encode(self, texts: list[str], memory: dict) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, n+1 offsets) of some texts; ``memory`` keeps units' pieces."""
        if "find" not in memory:
            memory["find"] = self.pattern().findall
            self.forget(memory)
        cut = [self.units(t, memory["find"]) for t in texts]
        known = memory["known"]
        new = list({u for units in cut for u in units if u not in known})
        if len(known) + len(new) > MEMORY:
            known = self.forget(memory)
            new = list({u for units in cut for u in units if u})
        if new:
            names, ids, sizes = self.segment(new)
            known.update(zip(names, range(len(known), len(known) + len(names))))
            memory["ids"] = np.concatenate([memory["ids"], *ids])
            memory["at"] = np.concatenate([memory["at"], memory["at"][-1] + np.cumsum(np.concatenate(sizes))])
        number = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64)
        first, size = memory["at"][number], memory["at"][number + 1] - memory["at"][number]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = memory["ids"][np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)]
        return ids, ends[np.concatenate([[0], np.cumsum([len(units) for units in cut])])]

    def forget(self, memory: dict) -> dict:
        """Start the memory of units anew, with the unit ''."""
        literal = self.byte_ids[list(SPACE.encode())]
        memory.update(known={"": 0}, ids=literal, at=np.array([0, len(literal)]))
        return memory["known"]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of id lists: pieces joined, bytes decoded (invalid UTF-8 as
        U+FFFD), the dummy space taken off."""
        size = self.raw_at[ids + 1] - self.raw_at[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ends[-1]) + np.repeat(self.raw_at[ids] - ends[:-1], size)
        data, cut, out = self.raw[at].tobytes(), ends[offsets], []
        for i in range(len(offsets) - 1):
            text = data[cut[i]:cut[i + 1]].decode("utf-8", "replace")
            out.append(text[1:] if self.dummy and text[:1] == " " else text)
        return out


def load(path: str) -> bytes:
    """The model file's bytes; it travels to every executor, so its size is checked."""
    with open(path, "rb") as file:
        data = file.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{path} has more than {MODEL_BYTES} bytes")
    return data


def encode(docs: DataFrame, text: str, model: str = MODEL) -> DataFrame:
    """``docs`` with ``ids`` (array<int>, the pieces of the text) and ``decoded``
    (the text decoded from them; equal to the text unless the model's rules
    squeeze spaces).

    Null texts have null ids; empty texts have none; every character is
    encodable (byte pieces). Extra columns pass through (``ids`` and ``decoded``,
    if present, are replaced); repeated rows are encoded each; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    data = spark.sparkContext.broadcast(load(model))
    keep = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    schema = StructType(list(docs.select(*keep).schema)).add("ids", ArrayType(IntegerType())).add("decoded", StringType())
    state: dict = {}

    def run(batch):
        if "model" not in state:
            state["model"], state["memory"] = Subwords(read_model(data.value)), {}
        column = batch.column(keep.index(text))
        texts = column.to_pylist()
        pieces, decoded = [], []
        for i in range(0, len(texts), 200):
            part = [t or "" for t in texts[i:i + 200]]
            ids, offsets = state["model"].encode(part, state["memory"])
            decoded += state["model"].decode(ids, offsets)
            array = lists(ids, offsets, pa.int32())
            pieces.append(array)
        ids = pa.concat_arrays(pieces)
        if column.null_count:
            missing = [t is None for t in texts]
            ids = pa.array([None if no else x for no, x in zip(missing, ids.to_pylist())], pa.list_(pa.int32()))
            decoded = [None if no else t for no, t in zip(missing, decoded)]
        yield {c: batch.column(i) for i, c in enumerate(keep)} | {"ids": ids, "decoded": decoded}

    return map_batches(docs.select(*keep), run, schema)


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (encode(docs, "text").select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                                        F.sha2("decoded", 256).alias("decoded_sha256"),
                                        F.col("decoded").eqNullSafe(F.col("text")).alias("exact")))
