"""Near-duplicate groups by min-max hashing.

Every permutation keeps both its minimum and its maximum over a document's shingles, so 64 hash
evaluations per shingle give 128 signature values.  Minimum and maximum each agree with
probability equal to the Jaccard similarity, so bands over the mixed values stay unbiased.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (BLANKS, WordHasher, _odd, bound_batches, by_id, byte_list, connected_components, materialize, mix,
                               separator_mask, slices, tidy, windows)

PERMUTATIONS = 64  # 128 values
BAND_VALUES = 4    # 32 bands; a pair of similarity 0.8 shares none with probability (1 - 0.8**4)**32 = 5e-8
SHINGLE_WORDS = 5
PERCENT = 80
SMALL_BUCKET = 64  # up to here the open pairs of a bucket are made by a join, beyond it in blocks
BLOCK = 512


def _shingles(texts: list[bytes], hasher: WordHasher, size: int):
    _, _, _, h, owner = hasher.words([t.lower() for t in texts])  # bytes.lower() maps A-Z only
    return windows(h, owner, len(texts), size)


def _signatures(batches, size: int, permutations: int, band_values: int):
    hasher = WordHasher(separator_mask(BLANKS))
    a, b = _odd(11, permutations), _odd(13, permutations)
    bands = 2 * permutations // band_values
    step = np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        for part in slices(batch, "text"):
            n = part.num_rows
            x, owner = _shingles(byte_list(part.column("text")), hasher, size)
            count = np.bincount(owner, minlength=n)
            have = np.flatnonzero(count)
            first = (np.cumsum(count) - count)[have]
            sizes, prints = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64)
            keys = np.zeros((n, bands), np.uint64)
            if len(have):
                for i, f in zip(have, first):
                    u = np.unique(x[f:f + count[i]])
                    sizes[i] = len(u)
                    prints[i] = mix(u).sum(), mix(u ^ step).sum()
                sig = np.empty((2 * permutations, len(have)), np.uint64)
                y = np.empty_like(x)
                for k in range(permutations):
                    np.multiply(x, a[k], out=y)
                    np.add(y, b[k], out=y)
                    sig[k] = np.minimum.reduceat(y, first)
                    sig[permutations + k] = np.maximum.reduceat(y, first)
                # rows k, k + bands, ... so that a band never holds both ends of one permutation
                for j in range(bands):
                    key = np.full(len(have), j + 1, np.uint64)
                    for row in sig[j::bands]:
                        key = mix(key * step + row)
                    keys[have, j] = key
            values = pa.array(keys.view(np.int64).ravel())
            nested = pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), values)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(prints[:, 0].view(np.int64)),
                 pa.array(prints[:, 1].view(np.int64)), nested], names=["doc_id", "n_shingles", "p0", "p1", "bands"])
    tidy()


def _sets(batches, size: int):
    hasher = WordHasher(separator_mask(BLANKS))
    for batch in batches:
        for part in slices(batch, "text"):
            n = part.num_rows
            x, owner = _shingles(byte_list(part.column("text")), hasher, size)
            ends = np.cumsum(np.bincount(owner, minlength=n))
            sets = [np.unique(s).view(np.int64) for s in np.split(x, ends[:-1])]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))],
                names=["doc_id", "shingles"])
    tidy()


def _sets_of(rows: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids(doc_id)``."""
    return materialize(by_id(rows, ids, "left_semi").mapInArrow(
        partial(_sets, size=size), "doc_id long, shingles array<long>"), "shingle-sets")


def _links(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs(u, v)`` whose full shingle sets meet the threshold."""
    ids = pairs.select(F.col("u").alias("doc_id")).unionAll(pairs.select(F.col("v").alias("doc_id")))
    sets = _sets_of(rows, ids, size)
    joined = (pairs.join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv")), "v")
              .join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su")), "u"))
    common = F.size(F.array_intersect("su", "sv"))
    return joined.withColumn("common", common).filter(
        100 * F.col("common") >= percent * (F.size("su") + F.size("sv") - F.col("common"))).select("u", "v")


def _compare(pdf, percent: int):
    """Links of one block: every stray against every member of another component."""
    import pandas as pd
    strays, members = pdf[pdf.side == 0], pdf[pdf.side == 1]
    if strays.empty or members.empty:
        return pd.DataFrame({"u": [], "v": []}, dtype="int64")
    sets = members.shingles.to_numpy()
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    ids, comps = members.rep.to_numpy(), members.component.to_numpy()
    out = []
    for rep, comp, own in zip(strays.rep, strays.component, strays.shingles):
        lo, hi = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        hit = np.flatnonzero(hi > lo)
        n = hi[hit] - lo[hit]
        at = np.repeat(lo[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(sets))
        ok = np.flatnonzero((100 * common >= percent * (sizes + len(own) - common)) & (comps != comp))
        # one link to each other component is all that connectivity needs
        out += [(rep, ids[ok[i]]) for i in np.unique(comps[ok], return_index=True)[1]]
    return pd.DataFrame(out, columns=["u", "v"], dtype="int64")


def _block_links(open_rows: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Links across components inside large buckets, found block by block without making pairs.

    Buckets with the same main component are taken together.  Every member outside the main
    component (a stray) is compared with every member; a block holds at most about ``BLOCK``
    strays and ``BLOCK`` members, so no group grows with the data.
    """
    members = materialize(open_rows.select("main", "rep", "component").distinct(), "members")
    counts = members.groupBy("main").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"),
        F.ceil(F.count(F.when(F.col("component") != F.col("main"), 1)) / BLOCK).cast("int").alias("ns"))
    members = members.join(counts, "main")
    home = F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int")
    stray = F.pmod(F.xxhash64("rep"), F.col("ns")).cast("int")
    dealt = members.select("main", "rep", "component", F.lit(1).alias("side"), home.alias("j"),
                           F.explode(F.sequence(F.lit(0), F.col("ns") - 1)).alias("i")).unionByName(
        members.filter("component <> main").select(
            "main", "rep", "component", F.lit(0).alias("side"), stray.alias("i"),
            F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("j")))
    ids = members.select(F.col("rep").alias("doc_id"))
    sets = _sets_of(rows, ids, size).withColumnRenamed("doc_id", "rep")
    return (dealt.join(sets, "rep").groupBy("main", "i", "j")
            .applyInPandas(lambda pdf: _compare(pdf, percent), "u long, v long"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT,
                    permutations: int = PERMUTATIONS, band_values: int = BAND_VALUES) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |A and B| >= ``percent`` * |A or B| over their sets of distinct
    ``size``-word shingles (64-bit hashes; A-Z lower-cased; blanks split words).

    1. Equal sets form a class, found by a 128-bit fingerprint; only the class's smallest id goes on.
    2. Classes that share a band meet.  First every member is held against its bucket's smallest
       id, so a bucket of thousands gives thousands of pairs and not their square.
    3. Members of a bucket whose components still differ are then all held against one another,
       large buckets in blocks that emit links only.  Connected copies need no further test.
    4. All tests are on full sets.  Components come from star contraction.

    Null or empty text, or text without words: n_shingles 0, own component.  Null doc_id:
    component_id null, kept.  Rows that repeat a doc_id are one document with several texts.
    Extra columns are ignored.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = materialize(rows.mapInArrow(
        partial(_signatures, size=size, permutations=permutations, band_values=band_values),
        "doc_id long, n_shingles long, p0 long, p1 long, bands array<long>"), "signatures")
    keyed = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = keyed.groupBy("n_shingles", "p0", "p1").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("members"), F.max("doc_id").alias("last"),
        F.first("bands").alias("bands"))
    classes = materialize(classes, "classes")

    # buckets of two classes or more
    entries = classes.select("rep", "n_shingles", F.explode("bands").alias("key"))
    full = (entries.groupBy("key").agg(F.min(F.struct("rep", "n_shingles")).alias("low"), F.max("rep").alias("top"))
            .filter("low.rep <> top").select("key", F.col("low.rep").alias("pivot"), F.col("low.n_shingles").alias("pn")))
    met = materialize(entries.join(full, "key"), "buckets")

    near = f"100 * least(n_shingles, pn) >= {percent} * greatest(n_shingles, pn)"
    star = (met.filter(f"rep <> pivot AND {near}").select(F.col("pivot").alias("u"), F.col("rep").alias("v"))
            .distinct())
    # one document id under several texts joins the classes of its texts
    tied = (keyed.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").join(keyed, "doc_id")
            .join(classes, ["n_shingles", "p0", "p1"]).select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    star = materialize(star, "star")
    links = materialize(_links(star, rows, size, percent).unionAll(tied), "links")
    found = materialize(connected_components(links), "components")

    # members of one bucket that are not connected yet
    left = met.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"))
    keys = (left.groupBy("key", "component").agg(F.count("*").alias("n"))
            .groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("parts"),
                                F.max_by("component", F.struct("n", "component")).alias("main")).filter("parts > 1"))
    left = materialize(left.join(keys.drop("parts"), "key"), "open")
    small = left.filter(F.col("n") <= SMALL_BUCKET)
    right = small.select("key", F.col("rep").alias("v"), F.col("n_shingles").alias("pn"), F.col("component").alias("cv"))
    rest = (small.join(right, "key").filter(f"rep < v AND component <> cv AND {near}")
            .select(F.col("rep").alias("u"), "v").distinct().join(star, ["u", "v"], "left_anti"))
    more = _links(materialize(rest, "rest"), rows, size, percent)
    more = more.unionAll(_block_links(left.filter(F.col("n") > SMALL_BUCKET), rows, size, percent))
    comps = connected_components(found.select(F.col("id").alias("u"), F.col("component").alias("v")).unionAll(more))

    top = classes.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(
        "n_shingles", "p0", "p1", F.coalesce("component", "rep").alias("component"), "members", "last", "rep")
    # classes of one document need no join back by their fingerprint
    moved = materialize(top.filter("members > 1 OR component <> rep"), "moved")
    out = sig.drop("bands").join(moved.select("n_shingles", "p0", "p1", "component"),
                                 ["n_shingles", "p0", "p1"], "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the smallest doc_id stays.

    Of rows that repeat a kept doc_id, the one of smallest text stays (a null text is the smallest), of
    equal ones that of smallest columns as JSON.  Rows without doc_id, and documents without words, stay.
    Without documents there are no rows; all columns are kept, whatever their names.
    """
    judged = materialize(near_duplicates(docs, **options).select("doc_id", "kept"), "kept")
    kept = by_id(docs, judged.filter("NOT kept"), "left_anti")
    repeated = judged.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    several = by_id(kept, repeated, "left_semi").select("doc_id", whole.alias("row"), F.struct(
        F.col("text"), F.to_json(whole)).alias("place"))
    one = several.groupBy("doc_id").agg(F.min_by("row", "place").alias("row"))
    return by_id(kept, repeated, "left_anti").unionAll(one.select("row.*"))
