"""Near-duplicate groups of documents.

Method: sequential Bayesian verification of banded MinHash candidates. Documents with the same shingle
set form one class. Classes that agree on a whole band of their signature are candidates; the signatures
of a candidate pair are compared batch by batch, and the pair is dropped as soon as the posterior chance
that its similarity reaches the threshold falls below `MISS`. Survivors are verified on full shingle
sets. Linked classes are joined to components by hooking and pointer jumping.

A band may gather a large group. No pair list of a group is made: its members are compared with one pivot
and what links is joined. Where a bucket still holds several components, its members are dealt into chunks
of bounded size, and chunks that share a bucket are compared as a whole, on full sets, emitting only the few
links that connect components. So every candidate is settled, whatever the size of its bucket.

Rows: one per input row. Null, empty and blank texts have no shingles and link with nothing. Rows without
a doc_id take no part: component_id is null and they are kept. Repeated rows fall into one class and are each
returned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.common import U64, WordHashes, arrow_batches, batch_rows, mix, per_text, shingles, signed, words_of
from lendframe.session import materialise

BANDS = 40
BAND_MISS = 1e-5  # largest chance that a pair at the threshold shares no band
COMPARED = 128  # signature values kept for the sequential test
BATCH = 16  # values compared before each posterior bound
MISS = 1e-6  # posterior chance below which a pair is dropped
_CHUNK = 2048  # shingles hashed at once, a memory bound
# Members up to which a bucket's open pairs are listed; larger buckets are compared chunk by chunk.
SMALL_BUCKET = 16
CHUNK_SHINGLES = 60_000  # of a chunk, on average
CELLS_AT_ONCE = 8_000_000  # of the grid of members and shingles, a memory bound


def band_rows(threshold: float, bands: int = BANDS) -> int:
    """Most rows per band such that a pair at `threshold` is missed with chance `BAND_MISS` at most."""
    rows = 1
    while (1 - threshold ** (rows + 1)) ** bands <= BAND_MISS:
        rows += 1
    return rows


def least_matches(threshold: float, compared: int = COMPARED, batch: int = BATCH) -> list[int]:
    """Matches a pair needs after each batch so that its posterior chance of reaching `threshold` stays
    above `MISS` (uniform prior: the posterior tail is a binomial sum)."""
    least = []
    for n in range(batch, compared + 1, batch):
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= MISS:
                break
            m += 1
        least.append(m)
    return least


class Sketcher:
    """Shingle set, set fingerprint, band keys and short signature of a text."""

    def __init__(self, width: int, threshold: float, bands: int = BANDS):
        self.width, self.bands, self.rows = width, bands, band_rows(threshold, bands)
        n = max(bands * self.rows, COMPARED)
        self.factors = (mix(np.arange(1, n + 1, dtype=U64) * U64(0xD6E8FEB86659FD93)) | U64(1))[:, None]
        self.weights = mix(np.arange(1, n + 1, dtype=U64)) | U64(1)
        self.words = WordHashes()

    def set_of(self, text: str | None) -> np.ndarray:
        return shingles(self.words.of(words_of(text)), self.width)

    def signature(self, x: np.ndarray) -> np.ndarray:
        least = None
        for at in range(0, len(x), _CHUNK):
            part = (self.factors * x[None, at : at + _CHUNK]).min(axis=1)
            least = part if least is None else np.minimum(least, part)
        return least

    def sketch(self, text: str | None) -> tuple:
        x = self.set_of(text)
        if len(x) == 0:
            return 0, 0, 0, b"", []
        s = self.signature(x)
        used = s[: self.bands * self.rows].reshape(self.bands, self.rows)
        keys = mix((used * self.weights[: used.size].reshape(used.shape)).sum(axis=1) + np.arange(self.bands, dtype=U64))
        prints = signed(np.array([mix(x).sum(), mix(x ^ U64(0x5851F42D4C957F2D)).sum()], U64))
        short = (s[:COMPARED] >> U64(48)).astype(np.uint16).tobytes()
        return len(x), int(prints[0]), int(prints[1]), short, signed(keys)


def sketches(docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """doc_id, n_shingles, set fingerprint (fp1, fp2), signature and band keys of every row."""
    schema = "n_shingles long, fp1 long, fp2 long, signature binary, bands array<long>"
    return per_text(docs, "text", ("doc_id",), schema, lambda: Sketcher(width, threshold).sketch)


def _survivors(pairs: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that pass the sequential test on their signatures."""
    least = least_matches(threshold)
    both = (
        pairs.join(signatures.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
        .join(signatures.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = len(batch)
            left, right = (
                np.frombuffer(b"".join(batch[c]), np.uint16).reshape(n, COMPARED) for c in ("sa", "sb")
            )
            alive, matches = np.arange(n), np.zeros(n, np.int64)
            for k, need in enumerate(least):
                part = slice(k * BATCH, (k + 1) * BATCH)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= need]
            yield batch.iloc[alive][["a", "b"]]

    return both.mapInPandas(run, "a long, b long").distinct()


def _links(survivors: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Surviving pairs whose full sets reach the threshold."""
    both = (
        survivors.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb")), "b")
        .select("a", "b", "xa", "xb")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for p, q in zip(batch["xa"], batch["xb"]):
                x, y = np.asarray(p, np.int64), np.asarray(q, np.int64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[keep, ["a", "b"]]

    return both.mapInPandas(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over `links` (a, b), for every linked node.

    Every node takes over its smallest neighbour, chains of that are followed by pointer jumping, and the
    links between what came out are settled in the same way, until none is left.
    """
    edges = materialise(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"
    )
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        labels = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component"))
        labels = _jumped(materialise(labels, "labels"))
        if found is None:
            found = labels
        else:
            step = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
            found = found.join(step, found.component == step._n, "left")
            found = materialise(found.select("node", F.coalesce("_c", "component").alias("component")), "labels")
        for end in ("a", "b"):
            named = labels.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
            edges = edges.join(named, end)
        edges = edges.where("_a != _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        edges = materialise(edges.distinct(), "edges")
        if edges.isEmpty():
            return found


def _jumped(labels: DataFrame) -> DataFrame:
    """`labels` (node, component) with every component followed to its end."""
    while True:
        jump = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        after = labels.join(jump, labels.component == jump._n, "left")
        after = materialise(after.select("node", F.coalesce("_c", "component").alias("component"), F.col("component").alias("_old")), "labels")
        labels = after.select("node", "component")
        if after.where("component != _old").isEmpty():
            return labels


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("node"))
    return members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with component and bucket size, of the buckets that hold several components."""
    labelled = _labelled(members, labels)
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count(F.lit(1)).alias("size"))
        .where("_lo != _hi")
        .select("bucket", "size")
    )
    return labelled.join(mixed, "bucket").select("bucket", "node", "component", "size")


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of the buckets of `members` (bucket, node, component), as few as
    connect what is linked.

    Members of buckets that overlap are dealt into chunks of bounded size; two chunks meet in one row where
    some bucket holds members of both, and their sets are compared there, so that no pairs are emitted.
    """
    hub = members.groupBy("bucket").agg(F.min("node").alias("b"))
    families = components(members.join(hub, "bucket").select(F.col("node").alias("a"), "b"))
    families = families.withColumnRenamed("component", "family")
    nodes = members.select("node", "component").distinct().join(families, "node").join(sets, "node")
    nodes = materialise(nodes, "family")
    sizes = nodes.groupBy("family").agg(F.ceil(F.sum(F.size("shingles")) / CHUNK_SHINGLES).alias("chunks"))
    place = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    placed = nodes.select("node", "family").join(sizes, "family").select("node", "family", place.alias("chunk"))
    packed = (
        nodes.join(sizes, "family")
        .groupBy("family", place.alias("chunk"))
        .agg(F.collect_list(F.struct("node", "component", "shingles")).alias("members"))
    )
    packed = materialise(packed, "chunks")
    inside = members.select("bucket", "node").join(placed, "node").select("bucket", "family", "chunk").distinct()
    other = inside.select("bucket", F.col("chunk").alias("chunk_b"))
    meet = inside.join(other, "bucket").where("chunk <= chunk_b").select("family", "chunk", "chunk_b").distinct()
    second = packed.select("family", F.col("chunk").alias("chunk_b"), F.col("members").alias("members_b"))
    rows = meet.join(packed, ["family", "chunk"]).join(second, ["family", "chunk_b"]).select("members", "members_b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for left, right in zip(batch["members"], batch["members_b"]):
                yield pd.DataFrame(_chunk_links(left, right, percent), columns=["a", "b"]).astype("int64")

    with batch_rows(members.sparkSession, 8):
        return materialise(rows.mapInPandas(run, "a long, b long").distinct(), "links")


def _chunk_links(left: list[dict], right: list[dict], percent: int) -> list[tuple[int, int]]:
    """(lower, higher) nodes of links between different components of two chunks, without closing circles."""
    both = [*left, *right]
    node = [m["node"] for m in both]
    held = [np.asarray(m["shingles"], np.int64) for m in both]
    # Shingles that one member alone holds meet no other; the rest become columns.
    values, column, count = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    size = np.array([len(x) for x in held])
    use = count[column] > 1
    row = np.repeat(np.arange(len(both)), size)[use]
    column = (np.cumsum(count > 1) - 1)[column[use]]
    width, step, n = int((count > 1).sum()), max(1, CELLS_AT_ONCE // len(both)), len(left)
    common = np.zeros((n, len(right)), np.float32)
    for at in range(0, width, step):
        part = (column >= at) & (column < at + step)
        grid = np.zeros((len(both), min(step, width - at)), np.float32)
        grid[row[part], column[part] - at] = 1
        common += grid[:n] @ grid[n:].T
    # Components by number; row by row, so that many links of few components are never listed.
    group = np.unique([m["component"] for m in both], return_inverse=True)[1]
    out = []
    for i in range(n):
        shared = common[i].astype(np.int64)
        near = 100 * shared >= percent * (size[i] + size[n:] - shared)
        for j in np.flatnonzero(near & (group[n:] != group[i])).tolist():
            if group[n + j] != group[i]:
                group[group == group[n + j]] = group[i]
                out.append((min(node[i], node[n + j]), max(node[i], node[n + j])))
    return out


def _settle(members: DataFrame, signatures: DataFrame, sets: DataFrame, threshold: float, percent: int) -> DataFrame | None:
    """(node, component) of all linked candidates of `members` (bucket, node); None if nothing links."""
    spark = members.sparkSession

    def verified(pairs: DataFrame) -> DataFrame:
        passed = materialise(_survivors(materialise(pairs.distinct(), "pairs"), signatures, threshold), "survivors")
        with batch_rows(spark, 200):
            return materialise(_links(passed, sets, percent), "links")

    # First every member meets one pivot of its bucket.
    pivots = members.groupBy("bucket").agg(F.min("node").alias("pivot"))
    rest = members.join(pivots, "bucket").where("node != pivot")
    links = verified(rest.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    labels = None if links.isEmpty() else components(links)
    # Then, where different components still share a bucket, all their other members meet.
    left = materialise(_open(rest.select("bucket", "node"), labels), "open")
    small = left.where(F.col("size") <= SMALL_BUCKET).select("bucket", F.col("node").alias("a"), "component")
    partner = small.select("bucket", F.col("a").alias("b"), F.col("component").alias("_c"))
    pairs = small.join(partner, "bucket").where("a < b AND component != _c").select("a", "b")
    found = verified(pairs)
    large = left.where(F.col("size") > SMALL_BUCKET)
    if not large.isEmpty():
        found = found.unionByName(_block_links(large.select("bucket", "node", "component"), sets, percent))
    if found.isEmpty():
        return labels
    return components(found.unionByName(links))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per row of `docs` (doc_id, text).

    Links: similarity of distinct `width`-word shingle sets of at least `percent` in a hundred.
    """
    arrow_batches(docs.sparkSession)
    threshold = percent / 100
    sketched = materialise(sketches(docs, width, threshold), "sketches")
    key = ["fp1", "fp2", "n_shingles"]
    classes = (
        sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*key)
        .agg(F.min(F.struct("doc_id", "signature", "bands")).alias("first"))
        .select(*key, "first.*")
        .withColumnRenamed("doc_id", "node")
    )
    classes = materialise(classes, "classes")
    all_members = classes.select("node", F.explode("bands").alias("bucket"))
    shared = all_members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = materialise(all_members.join(shared, "bucket").select("bucket", "node"), "members")
    candidates = members.select("node").distinct()
    signatures = materialise(classes.select("node", "signature").join(candidates, "node", "left_semi"), "signatures")
    # The merge join keeps the plan alike at every size; a copy of all candidate ids would grow with the input.
    wanted = candidates.withColumnRenamed("node", "doc_id").hint("merge")
    texts = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")

    def start() -> Callable[[str | None], tuple]:
        sketcher = Sketcher(width, threshold)
        return lambda t: (signed(sketcher.set_of(t)),)

    # Repeated rows of a document give one set.
    found = per_text(texts, "text", ("doc_id",), "shingles array<long>", start)
    sets = found.groupBy("doc_id").agg(F.max("shingles").alias("shingles")).withColumnRenamed("doc_id", "node")
    sets = materialise(sets, "sets")
    labels = _settle(members, signatures, sets, threshold, percent)
    named = _labelled(classes.select(*(F.col(k).alias(f"_{k}") for k in key), "node"), labels)
    named = named.select(*(f"_{k}" for k in key), F.col("component").alias("_component"))
    same = [F.col(k) == F.col(f"_{k}") for k in key]
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("_component"))
    return (
        sketched.select("doc_id", *key)
        .join(named, same, "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )
