"""English stems by Porter's suffix rules (M. F. Porter, An algorithm for suffix stripping, 1980).

Stemming runs on the distinct words of a slice of an Arrow batch, so a worker's memory is bounded by one
batch and one slice; a document's words are counted where its row is, so only (document, stem, count) rows are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalar import tokenize

# The rule tables of the published algorithm, suffix -> replacement.
DOUBLE_SUFFIXES = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
SINGLE_SUFFIXES = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
LAST_SUFFIXES = {s: "" for s in ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
                                 "ou", "ism", "ate", "iti", "ous", "ive", "ize")}


def _kinds(word: str) -> str:
    """The word with v for vowels and c for consonants; y is a vowel behind a consonant."""
    out = ""
    for ch in word:
        out += "v" if ch in "aeiou" or (ch == "y" and out[-1:] == "c") else "c"
    return out


def _measure(stem: str) -> int:
    """How often consonants follow vowels in the stem."""
    return _kinds(stem).count("vc")


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _kinds(word)[-1] == "c"


def _short_end(word: str) -> bool:
    """Ends in consonant, vowel, consonant, the last not w, x or y."""
    return _kinds(word).endswith("cvc") and word[-1] not in "wxy"


def _replace(word: str, rules: dict, measure: int) -> str:
    """The longest suffix of ``rules`` replaced if the stem before it measures more than ``measure``."""
    for n in range(min(len(word), 7), 1, -1):
        if word[-n:] in rules:
            stem = word[:-n]
            if word[-n:] == "ion" and stem[-1:] not in ("s", "t"):
                return word
            return stem + rules[word[-n:]] if _measure(stem) > measure else word
    return word


def stem(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters, or with other signs than a-z, stay."""
    if len(word) < 3 or not (word.isascii() and word.isalpha() and word.islower()):
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        cut = 2 if word.endswith("ed") else 3 if word.endswith("ing") else 0
        if cut and "v" in _kinds(word[:-cut]):
            word = word[:-cut]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _doubled(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short_end(word):
                word += "e"
    if word.endswith("y") and "v" in _kinds(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(word, DOUBLE_SUFFIXES, 0)
    word = _replace(word, SINGLE_SUFFIXES, 0)
    word = _replace(word, LAST_SUFFIXES, 1)
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


SLICE_WORDS = 1 << 18


def slices(batch: pa.RecordBatch):
    """(ids, word lists) of runs of a batch's rows with about ``SLICE_WORDS`` words, one row at least."""
    ids, lists = batch.columns
    ends = lists.offsets.to_numpy()[1:]
    start, n = 0, batch.num_rows
    while start < n:
        before = ends[start - 1] if start else lists.offsets[0].as_py()
        stop = max(int(np.searchsorted(ends, before + SLICE_WORDS, side="right")), start + 1)
        yield ids.slice(start, stop - start), lists.slice(start, stop - start)
        start = stop


def doc_stems(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, term, tf): stem counts of whole documents.

    Words are those of :func:`quarry.functions.scalar.tokenize`.  Rows of one id count together; rows
    without id or words give nothing.
    """
    rows = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), tokenize(text_col).alias("words"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])

    def count(batches):
        for batch in batches:
            for ids, lists in slices(batch):
                words = lists.flatten().dictionary_encode()
                if not len(words):
                    continue
                stems, code = np.unique([stem(w) for w in words.dictionary.to_pylist()], return_inverse=True)
                lengths = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()), 0)
                row = np.repeat(np.arange(len(ids), dtype=np.int64), lengths)
                pair, tf = np.unique(row * len(stems) + code[words.indices.to_numpy()], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(pair // len(stems))),
                     pa.array(stems.tolist(), pa.string()).take(pa.array(pair % len(stems))),
                     pa.array(tf.astype(np.int64))], names=["doc_id", "term", "tf"])

    return rows.mapInArrow(count, schema).groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
