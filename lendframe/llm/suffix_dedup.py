"""Passages that repeat across documents, found by a sparse suffix array.

Method: of all suffixes of the word sequence of a text, only those at content-selected positions are kept:
the minimiser (lowest hash of `KEY` words) of each run of `reach` positions. Every window of `length` words
holds the minimiser of its first `reach` positions, and equal windows hold the same one at the same offset.

Equal suffixes collapse first. The others are sorted over range partitions by the hash of their first `length - reach`
words, then by the hash of their whole stretch, so the order is that of hashes, not of letters; one pass over each sorted
partition compares neighbours. A run of suffixes that begin alike drops out if it is of one document; runs cut by
a border of two partitions are settled from one row per border. The others are extended to the left and to the right over
all windows that belong to the minimiser, first whole (one hash for the whole stretch), then, where stretches of
neighbours differ, window by window.

A position is reported exactly if a window of `length` words around it occurs in another document, up to
collisions of 128-bit keys. Copies collapse in partial aggregates, a run of any length is read as a stream, so no group of
copies meets in one task, and no pairs are made.

Rows: one per maximal repeated passage of a document. Null, empty and shorter texts have none, nor have rows
without a doc_id. Repeats within one document only, and repeated rows of one doc_id, are not reported. Long texts are read
whole. Of equal windows the lowest doc_id is the first. Only doc_id and text are read; other columns, whatever their names, change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import SpanHashes, WordHashes, arrow_batches, batch_rows, per_text, signed, words_of
from lendframe.session import materialise

LENGTH = 50  # words
KEY = 5
NARROW_ROWS = 20_000  # rows of a few numbers handed to Python at a time
# What a row of a sorted partition is: a suffix with neighbours in other documents, one at a border, a border's summary.
ALIKE, UNSURE, BORDER = 0, 1, 2


class Suffixes:
    """Kept suffixes of a text and the windows that belong to each."""

    def __init__(self, length: int):
        self.length, self.reach = length, max(1, length * 3 // 5)
        self.key = min(KEY, length - self.reach + 1)
        self.words = WordHashes()

    def _windows(self, text: str | None):
        """Span hashes, word count, kept positions, first and last window of each; None if too short."""
        hashes = self.words.of(words_of(text))
        n = len(hashes)
        if n < self.length:
            return None
        spans = SpanHashes(hashes)
        at = np.arange(n - self.key + 1)
        order = spans.of(at, at + self.key)
        starts = n - self.length + 1
        chosen = np.arange(starts) + sliding_window_view(order, self.reach)[:starts].argmin(axis=1)
        change = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        return spans, n, chosen[change], change, np.r_[change[1:], starts] - 1

    def kept(self, text: str | None) -> tuple:
        """Hashed prefix, hashed stretch, first and last window of each suffix, as four arrays."""
        found = self._windows(text)
        if found is None:
            return [], [], [], []
        spans, _, position, first, last = found
        prefix = signed(spans.of(position, position + self.length - self.reach))
        # The offset of the suffix in its stretch is part of the stretch's identity.
        stretch = signed(spans.of(first, last + self.length) ^ (position - first).astype(np.uint64))
        return prefix, stretch, first.astype(np.int32), last.astype(np.int32)

    def windows(self, text: str | None, firsts) -> tuple:
        """First window of the stretch, offset and hash of all windows of the stretches in `firsts`, as arrays."""
        found = self._windows(text)
        if found is None:
            return [], [], []
        spans, _, _, first, last = found
        wanted = np.isin(first, np.asarray(firsts, np.int64))
        first, many = first[wanted], (last - first + 1)[wanted]
        start = np.repeat(first, many)
        offset = np.arange(len(start)) - np.repeat(np.cumsum(many) - many, many)
        hashed = signed(spans.of(start + offset, start + offset + self.length))
        return start.astype(np.int32), offset.astype(np.int32), hashed


def _all_suffixes(docs: DataFrame, length: int) -> DataFrame:
    kind = "prefix array<long>, stretch array<long>, first array<int>, last array<int>"
    rows = per_text(docs.where("doc_id IS NOT NULL"), "text", ("doc_id",), kind, lambda: Suffixes(length).kept)
    return rows.select("doc_id", F.inline(F.arrays_zip("prefix", "stretch", "first", "last")))


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of equal prefixes in one sorted partition of prefix, stretch, lo, hi, at: the rows of runs that hold two
    documents, with `n` (suffixes of the run, 2 for more). Rows of a run at the partition's start or end that may have more neighbours
    beyond it are `UNSURE`, and such a run gives a `BORDER` row.

    Held back are rows of the open run while it is of one document or has one row, so never more than a document's.
    """
    columns = ["prefix", "stretch", "lo", "hi", "at"]
    held: pd.DataFrame | None = None
    # The part of the open run that went out already: documents and rows.
    low = high = None
    sent, first_run = 0, True

    def of(rows: pd.DataFrame, kind, n) -> pd.DataFrame:
        return rows.assign(kind=np.asarray(kind, np.int32), n=np.asarray(n, np.int32))

    def border(prefix, lo, hi, n) -> pd.DataFrame:
        return of(pd.DataFrame([(prefix, 0, lo, hi, 0)], columns=columns), [BORDER], [min(n, 2)])

    for batch in batches:
        rows = batch[columns] if held is None else pd.concat([held, batch[columns]], ignore_index=True)
        if not len(rows):
            continue
        prefix = rows["prefix"].to_numpy()
        start = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        size = np.diff(np.r_[start, len(rows)])
        lo = np.minimum.reduceat(rows["lo"].to_numpy(), start)
        hi = np.maximum.reduceat(rows["hi"].to_numpy(), start)
        many = size.copy()
        if sent and prefix[0] == open_prefix:
            lo[0], hi[0], many[0] = min(lo[0], low), max(hi[0], high), many[0] + sent
        elif sent and first_run:  # the first run ended with the batch before
            yield border(open_prefix, low, high, sent)
            first_run = False
        closed = len(start) - 1
        alike = lo != hi
        kind = np.where(alike, ALIKE, -1)
        if first_run and closed:
            kind[0] = ALIKE if alike[0] and many[0] > 1 else UNSURE
            yield border(prefix[0], lo[0], hi[0], many[0])
            first_run = False
        settled = bool(alike[-1] and many[-1] > 1)
        kind[-1] = ALIKE if settled else -1
        each = np.repeat(kind, size)
        out = each >= 0
        if out.any():
            yield of(rows[out], each[out], np.repeat(np.minimum(many, 2), size)[out])
        open_prefix = prefix[-1]
        if settled:
            held, low, high, sent = None, lo[-1], hi[-1], int(many[-1])
        else:
            held, low, high, sent = rows.iloc[start[-1] :], None, None, 0
    if held is not None:
        yield of(held, np.full(len(held), UNSURE), np.full(len(held), min(len(held), 2)))
        yield border(open_prefix, held["lo"].min(), held["hi"].max(), len(held))
    elif sent:
        yield border(open_prefix, low, high, sent)


def neighbours(suffixes: DataFrame) -> DataFrame:
    """prefix, stretch, lo, hi, at, several: distinct suffixes that begin like one of another document, from the sorted array.

    lo, hi: lowest and highest document with the whole stretch; at: where it stands in the lowest; several: are there
    other stretches that begin alike?
    """
    at = F.struct("doc_id", "first", "last")
    distinct = suffixes.groupBy("prefix", "stretch").agg(F.min(at).alias("one"), F.max("doc_id").alias("hi"))
    packed = F.shiftleft(F.col("one.first").cast("long"), 32) + F.col("one.last")
    distinct = distinct.select("prefix", "stretch", F.col("one.doc_id").alias("lo"), "hi", packed.alias("at"))
    array = distinct.repartitionByRange("prefix", "stretch").sortWithinPartitions("prefix", "stretch")
    kind = dict(distinct.dtypes)["lo"]
    schema = f"prefix long, stretch long, lo {kind}, hi {kind}, at long, kind int, n int"
    with batch_rows(suffixes.sparkSession, NARROW_ROWS):
        found = materialise(array.mapInPandas(_neighbours, schema), "neighbours")
    borders = found.where(F.col("kind") == BORDER).groupBy("prefix")
    borders = borders.agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"), F.sum("n").alias("_n")).where("_lo != _hi")
    # At most two borders per partition.
    unsure = found.where(F.col("kind") == UNSURE).join(F.broadcast(borders), "prefix")
    columns = "prefix", "stretch", "lo", "hi", "at"
    sure = found.where(F.col("kind") == ALIKE).select(*columns, (F.col("n") > 1).alias("several"))
    return sure.unionByName(unsure.select(*columns, (F.col("_n") > 1).alias("several")))


def passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, start_word, end_word, n_words, first_doc_id, parts per maximal passage of `docs` (doc_id, text) of which
    every word lies in a window of `length` words that another document holds. first_doc_id is the lowest
    document that shares a part of it. parts (start_word, end_word, first_doc_id) cut the passage where the lowest document that holds
    the windows changes: a part whose first_doc_id is the document's own is the one to keep."""
    suffixes = materialise(_all_suffixes(docs, length), "suffixes")
    entries = neighbours(suffixes)
    # Where neighbours differ somewhere in the stretch, one document of each stretch shows its windows.
    first = F.shiftright("at", 32).cast("int").alias("first")
    shown = entries.where("several").select("prefix", "stretch", "lo", "hi", F.col("lo").alias("doc_id"), first)
    asked = shown.groupBy("doc_id").agg(F.collect_set("first").alias("firsts"))
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL").join(asked, "doc_id")

    windows = _windows(texts, length)
    windows = windows.join(shown, ["doc_id", "first"]).select("prefix", "stretch", "lo", "hi", "offset", "window")
    shared = (
        windows.groupBy("prefix", "window")
        .agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"))
        .where("_lo != _hi")
    )
    held = (
        windows.join(shared, ["prefix", "window"])
        .groupBy("prefix", "stretch")
        .agg(F.collect_set(F.struct("offset", F.col("_lo").alias("other"))).alias("at"))
    )

    def beside(x, step):
        return F.array_contains("at", F.struct((x["offset"] + step).alias("offset"), x["other"].alias("other")))

    # Runs of shared windows with one lowest document; a stretch has few windows, so the lists are short.
    starts = F.array_sort(F.filter("at", lambda x: ~beside(x, -1)))
    ends = F.array_sort(F.filter("at", lambda x: ~beside(x, 1)))
    runs = held.select("prefix", "stretch", F.arrays_zip(starts.alias("a"), ends.alias("b")).alias("runs"))
    # Alone with its beginning, a stretch of several documents is shared whole.
    whole = entries.where("NOT several AND lo != hi").select("prefix", "stretch", F.col("lo").alias("whole"))
    found = whole.unionByName(runs, allowMissingColumns=True)
    near = suffixes.join(found, ["prefix", "stretch"])  # repeated spans of a document merge below
    stretch = F.struct(F.col("first").alias("start"), (F.col("last") + length).alias("end"), F.col("whole").alias("other"))
    run = F.transform("runs", lambda r: F.struct(
        (F.col("first") + r["a"]["offset"]).alias("start"), (F.col("first") + r["b"]["offset"] + length).alias("end"), r["a"]["other"].alias("other")
    ))
    spans = F.when(F.col("whole").isNotNull(), F.array(stretch)).otherwise(run)
    return _merged(near.select("doc_id", F.inline(spans)))


def _windows(texts: DataFrame, length: int) -> DataFrame:
    """doc_id, first, offset, window of the stretches that `texts` (doc_id, text, firsts) asks for."""
    arrow_batches(texts.sparkSession)

    @F.pandas_udf("first array<int>, offset array<int>, window array<long>")
    def run(text: pd.Series, firsts: pd.Series) -> pd.DataFrame:
        of = Suffixes(length)
        return pd.DataFrame([of.windows(t, f) for t, f in zip(text, firsts)], columns=["first", "offset", "window"])

    rows = texts.select("doc_id", run("text", "firsts").alias("w")).select("doc_id", "w.*")
    return rows.select("doc_id", F.inline(F.arrays_zip("first", "offset", "window"))).distinct()


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a document as one, and its parts; a document's spans are bounded by its length."""
    order = Window.partitionBy("doc_id").orderBy("start", "end", "other")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    until_now = order.rowsBetween(Window.unboundedPreceding, 0)
    reached = spans.withColumn("_reached", F.max("end").over(so_far)).withColumn("_before", F.lag("other").over(order))
    opened = reached.withColumn("_new", F.coalesce(F.col("start") > F.col("_reached"), F.lit(True)))
    opened = opened.withColumn("_other", F.col("_new") | ~F.col("other").eqNullSafe(F.col("_before")))
    numbered = opened.select(
        "doc_id", "start", "end", "other", "_reached", "_new",
        F.sum(F.col("_new").cast("int")).over(until_now).alias("_passage"),
        F.sum(F.col("_other").cast("int")).over(until_now).alias("_part"),
    )
    # A part begins where the one before it ends.
    begins = F.when(F.col("_new"), F.col("start")).otherwise(F.greatest("start", "_reached"))
    parts = numbered.groupBy("doc_id", "_passage", "_part").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min(begins).alias("begins"), F.first("other").alias("other")
    )
    part = F.struct(F.col("begins").alias("start_word"), F.col("end").alias("end_word"), F.col("other").alias("first_doc_id"))
    return (
        parts.groupBy("doc_id", "_passage")
        .agg(
            F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("other").alias("first_doc_id"),
            F.array_sort(F.collect_list(F.when(F.col("begins") < F.col("end"), part))).alias("parts"),
        )
        .select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "first_doc_id", "parts")
    )
