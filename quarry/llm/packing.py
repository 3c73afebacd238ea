"""Packing documents into training sequences by cutting-stock column generation.

One pass tokenizes every text and writes the ids to a scratch table.  A document's whole sequences
stand for themselves; its remainder, shorter than a sequence, is placed by a plan made on the driver
from the histogram of remainders (see :mod:`quarry.llm.cutting`; its size does not grow with the
corpus).  Documents are ranked among those of their remainder, and a document's rank gives its
sequence and offset by arithmetic alone: texts and ids of documents that stay whole are not shuffled.
"""

from __future__ import annotations

import codecs
import os
import re
import zlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_IDS, bound_batches, byte_list, materialize, share, shared, slices
from quarry.llm.cutting import PackPlan, plan

SEQUENCE = 2048
END_ID = 1
HELD_WORDS = 1 << 18  # distinct parts between blanks of a generation; a Python worker remembers two
HELD_BYTES = 64  # longer parts are not remembered

#: Rows of the offsets table that count a partition's whole sequences and not a remainder.
_WHOLE = -1

_PIECE = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
_PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                 "offset long")


#: The tokenizer's words, for texts of printable ASCII and the letters of Latin-1.
_WORD = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-zß-öø-ÿ0-9]+")
_OTHER = re.compile(r"[^\x21-\x7EÀ-ÖØ-öø-ÿ]")
_SPECIAL = "<|"  # begins the special tokens


def _byte_letters() -> str:
    """The signs that stand for the 256 bytes in a byte-level vocabulary: themselves if they are printable."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    letters = {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
    return "".join(letters[b] for b in range(256))


class _Remembered(dict):
    """Values of ``make(key)``, made when first asked for; :meth:`age` drops those not asked for lately."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(key) <= HELD_BYTES:
            self[key] = value
        return value

    def age(self):
        if len(self) > HELD_WORDS:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Ids of texts by the word-end BPE of a ``tokenizers`` file; frequent parts are remembered.

    White space ends every word of such a tokenizer and is dropped, and lower-cased words are encoded
    one by one, so a text's ids are those of its parts between ASCII blanks, one after the other, and
    a part's those of its words, each a part of its own.  Only parts of printable ASCII and Latin-1
    letters are cut into words here; others are left to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.packed = {i: i.to_bytes(self.dtype.itemsize, "little") for i in vocabulary.values()}
        self.letters = _byte_letters()
        self.parts = _Remembered(self._part)

    def _packed(self, ids) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = codecs.charmap_decode(word.encode(), "strict", self.letters)[0]
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(word)])

    def _part(self, part: bytes) -> bytes:
        if part.isalpha():  # ASCII letters alone
            word = part.lower()
            return self._word(word.decode()) if word == part else self.parts[word]
        text = part.decode("utf-8", "replace")
        if _OTHER.search(text) or _SPECIAL in text:
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        words = _WORD.findall(text.lower())
        if words == [text]:
            return self._word(text)
        return b"".join([self.parts[w.encode()] for w in words])

    def encode(self, texts: list[bytes], end_id: int) -> list[bytes]:
        """The ids of every text and ``end_id``, packed as ``dtype``."""
        self.parts.age()
        end, get = self._packed([end_id]), self.parts.__getitem__
        return [b"".join(map(get, t.split())) + end for t in texts]


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """The encoder of a Python worker, with the parts it remembers; it serves one task after the other."""
    return WordEncoder(path)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _encode(batches, path: str, size: int, end_id: int):
    """Ids, checksums and ranks within the partition of every row."""
    part = TaskContext.get().partitionId()
    encoder = _encoder(path)
    seen = np.zeros(size, np.int64)  # rows so far by remainder
    row = chunks = 0
    for batch in batches:
        for piece in slices(batch, "text"):
            ids = encoder.encode(byte_list(piece.column("text")), end_id)
            rest, rank, before, crcs = [], [], [], []
            for packed in ids:
                tokens = np.frombuffer(packed, encoder.dtype)
                r = len(tokens) % size
                rest.append(r)
                rank.append(int(seen[r]))
                seen[r] += 1
                before.append(chunks)
                chunks += len(tokens) // size
                crcs.append([_crc(tokens[i:i + size]) for i in range(0, len(tokens), size)])
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(np.full(n, part), pa.int64()),
                 pa.array(np.arange(row, row + n), pa.int64()),
                 pa.array([len(x) // encoder.dtype.itemsize for x in ids], pa.int64()), pa.array(rest, pa.int64()),
                 pa.array(rank, pa.int64()), pa.array(before, pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
                 pa.array(ids, pa.binary()), pa.array(np.full(n, encoder.dtype.itemsize), pa.int32())],
                names=["doc_id", "part", "row", "tokens", "rest", "rank", "chunk", "crcs", "ids", "id_bytes"])
            row += n


def _batch(columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _PIECE)],
                                      names=[name for name, _ in _PIECE])


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _place(batches, plan_of):
    """Pieces of whole sequences, and remainders that stay whole."""
    p: PackPlan = shared(plan_of)
    for batch in batches:
        ids = batch.column("doc_id")
        tokens, rest, rank, chunk = (_numbers(batch, c) for c in ("tokens", "rest", "rank", "chunk"))
        crcs = batch.column("crcs")
        flat, first = crcs.flatten().to_numpy(zero_copy_only=False), crcs.offsets.to_numpy()[:-1] - crcs.offsets[0].as_py()
        full = tokens // p.size
        doc = np.repeat(np.arange(len(tokens)), full)
        j = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
        stays = np.flatnonzero((rest > 0) & (rank < p.placed[rest]))
        at = p.place_base[rest[stays]] + rank[stays]
        entry = np.searchsorted(p.entry_from, at, side="right") - 1
        nth, each = at - p.entry_from[entry], p.entry_each[entry]
        rows = np.concatenate((doc, stays))
        if not len(rows):
            continue
        yield _batch([
            ids.take(pa.array(rows)), np.concatenate((j * p.size, full[stays] * p.size)),
            np.concatenate((np.full(len(doc), p.size), rest[stays])),
            np.concatenate((flat[first[doc] + j], flat[first[stays] + full[stays]])), tokens[rows],
            np.concatenate((p.sequences + chunk[doc] + j, p.entry_sequence[entry] + nth // each)),
            np.concatenate((np.zeros(len(doc), np.int64), p.entry_offset[entry] + nth % each * rest[stays]))])


def _cut(batches, plan_of):
    """Pieces of the remainders that fill gaps."""
    p: PackPlan = shared(plan_of)
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            tokens, rest = row["tokens"], row["rest"]
            begin = tokens - rest
            ids = np.frombuffer(row["ids"], "<u2" if row["id_bytes"] == 2 else "<u4")
            line = int(p.cut_base[rest] + (row["rank"] - p.placed[rest]) * rest)
            at, done = line, line + rest
            while at < done:
                g = int(np.searchsorted(p.line_from, at, side="right")) - 1
                nth, inside = divmod(at - int(p.line_from[g]), int(p.line_gap[g]))
                n = min(int(p.line_gap[g]) - inside, done - at)
                start = begin + at - line
                out.append((row["doc_id"], start, n, _crc(ids[start:start + n]), tokens,
                            int(p.line_sequence[g]) + nth, int(p.line_offset[g]) + inside))
                at += n
        if out:
            yield _batch(list(zip(*out)))


def _ranked(encoded: DataFrame, chosen: PackPlan) -> DataFrame:
    """The rows of ``encoded`` but for their ids, with ranks over all partitions.

    Counts by partition are summed up over partitions, one row for each partition and remainder.
    """
    spark = encoded.sparkSession
    counts = encoded.groupBy("part", "rest").agg(F.count("*").alias("n")).unionAll(
        encoded.groupBy("part").agg(F.sum(F.floor(F.col("tokens") / chosen.size)).alias("n"))
        .select("part", F.lit(_WHOLE).cast("long").alias("rest"), "n"))
    ahead = counts.selectExpr("part", "rest", "sum(n) OVER (PARTITION BY rest ORDER BY part) - n AS ahead")
    placed = spark.createDataFrame([(i, int(n)) for i, n in enumerate(chosen.placed)], "rest long, placed long")
    offsets = (ahead.filter(F.col("rest") != _WHOLE)
               .join(ahead.filter(F.col("rest") == _WHOLE).select("part", F.col("ahead").alias("chunks")), "part")
               .join(F.broadcast(placed), "rest"))  # one row a length
    return encoded.select("part", "row", "doc_id", "tokens", "rest", "rank", "chunk", "crcs").join(
        offsets, ["part", "rest"]).select("part", "row", "doc_id", "tokens", "rest", "crcs", "placed",
                                          (F.col("rank") + F.col("ahead")).alias("rank"),
                                          (F.col("chunk") + F.col("chunks")).alias("chunk"))


def pack(docs: DataFrame, path: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text by the tokenizer file ``path`` without special tokens, and
    ``end_id``; null and empty texts have that id alone.  Every id lies in one piece, every sequence
    holds ``size`` ids at most and its offsets have no gaps.  Sequences are padded by less than
    ``cutting.MIN_GAP`` ids, but for the last ones, whose lengths are powers of two.  Rows of one
    doc_id, null among them, are documents of their own.  No documents give no rows.  Extra columns
    are ignored.  Sequence ids have no order; which documents share a sequence follows from their
    places in the input's partitions.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    encoded = materialize(rows.mapInArrow(
        partial(_encode, path=path, size=size, end_id=end_id),
        "doc_id long, part long, row long, tokens long, rest long, rank long, chunk long, crcs array<long>, ids binary, "
        "id_bytes int"), "encoded")
    histogram = {r.rest: r.n for r in encoded.filter("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()}
    chosen = plan(histogram, size)
    ranked = materialize(_ranked(encoded, chosen), "ranked")
    plan_of = share(spark, chosen)
    whole = ranked.mapInArrow(partial(_place, plan_of=plan_of), _PIECE_SCHEMA)
    # the plan leaves few documents to be cut, but no bound on them
    given = ranked.filter("rest > 0 AND rank >= placed").select("part", "row", "rank")
    n_given = sum(n - int(chosen.placed[x]) for x, n in histogram.items())
    if n_given <= BROADCAST_IDS:
        given = F.broadcast(given)
    cut = (encoded.select("part", "row", "doc_id", "tokens", "rest", "ids", "id_bytes").join(given, ["part", "row"])
           .mapInArrow(partial(_cut, plan_of=plan_of), _PIECE_SCHEMA))
    return whole.unionAll(cut)
