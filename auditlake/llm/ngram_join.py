"""N-gram Jaccard join by bands of min-hashes, with exact verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import slices, stage
from auditlake.llm.components import components
from auditlake.llm.shingles import MinHash, set_key, shingle_sets

WORDS, SIMILAR = 5, 0.8
TREES, DEEPEST, RECALL = 20, 8, 0.9999
# A pair goes on to verification if so many standard errors below the threshold.
ERRORS = 5
# Rows of a bucket, and sets and shingles of a neighbourhood, that one task compares at once.
BUCKET_ROWS, BLOCK_SETS, BLOCK_SHINGLES = 1024, 256, 1 << 20
# Bits (as a power of 2, 15 at least) of the filter of keys that keeps other sets out of the shuffle: 16 MB.
FILTER_BITS = 27


def prefix_depth(similar: float = SIMILAR, trees: int = TREES, recall: float = RECALL) -> int:
    """Min-hashes in each band (tree): the most, up to the deepest, with which a pair at the threshold
    shares some band with probability ``recall``. No data is looked at. Pairs that share more
    hashes of a tree share these, so matching longer prefixes first would find the same pairs."""
    depth = DEEPEST
    while depth > 1 and 1 - (1 - similar**depth) ** trees < recall:
        depth -= 1
    return depth


def sketches(docs: DataFrame, ident: str, text: str, words: int, trees: int, depth: int) -> DataFrame:
    """(id, n, key, prefixes, signature) of each text: its number of shingles, a key of their set
    (null if empty), the prefix of its signature in each tree, and a byte of each min-hash."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = MinHash(trees * depth)
        mixer = np.cumprod(np.full(depth, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
        for batch in slices(batches):
            n, key, prefixes, signature = [], [], [], []
            for s in shingle_sets(batch.column(1).to_pylist(), words):
                n.append(len(s))
                if not len(s):
                    for out in (key, prefixes, signature):
                        out.append(None)
                    continue
                least = hashed(s)
                key.append(set_key(s))
                prefixes.append((least.reshape(trees, depth) * mixer).sum(axis=1).view(np.int64).tolist())
                signature.append((least & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int32()),
                    pa.array(key, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(signature, pa.binary()),
                ],
                names=["id", "n", "key", "prefixes", "signature"],
            )

    rows = docs.select(F.col(ident).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sketch, f"id {kind}, n int, key binary, prefixes array<long>, signature binary")


def key_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for each value of the first ``bits`` bits of a key, set if a key begins so.

    Tasks put the bits together, in pieces of 4 KB; the driver gets these and never a key."""
    cell = F.shiftrightunsigned(F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long"), 32 - bits)
    # Dealt before they are put together, so that a piece is made once and not in each task.
    cells = keys.select(F.shiftright(cell, 15).alias("piece"), cell.bitwiseAND((1 << 15) - 1).alias("bit"))
    pieces = cells.repartition("piece").groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits"))
    found = np.zeros((1 << (bits - 15), 1 << 12), np.uint8)
    for r in pieces.collect():
        found[r.piece] = np.frombuffer(r.bits, np.uint8)
    return found.reshape(-1)


def drop_rows(rows: DataFrame, number: str, dropped: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` without those whose ``number`` (long, not null) is among the ``dropped`` ones.

    A filter of fixed size tells which rows may be dropped: these are shuffled and looked up, all others
    stay where they are, with their texts. With many dropped rows the filter lets more through.
    """
    key = F.unhex(F.lpad(F.hex(F.xxhash64(number)), 16, "0"))
    sent = rows.sparkSession.sparkContext.broadcast(key_filter(dropped.select(key.alias("key")), bits))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        cell = (h.to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
        return pd.Series((sent.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool))

    marked = rows.withColumn("__maybe", maybe(F.xxhash64(number)))
    stay = marked.where(~F.col("__maybe"))
    return stay.unionByName(marked.where("__maybe").join(dropped.select(number), number, "left_anti")).drop("__maybe")


def sets_of(docs: DataFrame, text: str, words: int, keys: DataFrame) -> DataFrame:
    """(key, shingles): the sets with the given keys, once each."""
    bits = FILTER_BITS
    wanted = docs.sparkSession.sparkContext.broadcast(key_filter(keys, bits))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = {}
            for s in shingle_sets(batch.column(0).to_pylist(), words):
                if not len(s):
                    continue
                key = set_key(s)
                cell = int.from_bytes(key[:4], "big") >> (32 - bits)
                # Other sets that begin as a key does go on; the join drops them.
                if wanted.value[cell >> 3] >> (cell & 7) & 1:
                    found[key] = s.astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["key", "shingles"]
            )

    found = docs.select(F.col(text).alias("text")).mapInArrow(take, "key binary, shingles binary")
    return found.groupBy("key").agg(F.first("shingles").alias("shingles")).join(keys, "key")


def by_groups(rows: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` on runs of whole groups, sorted by ``keys``: many small groups in one call.

    A group has to fit into memory; callers split theirs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = (batch[keys] == batch[keys].iloc[-1]).all(axis=1).to_numpy()
            cut = len(last) - int(last[::-1].argmin() or (len(last) if last.all() else 0))
            if cut == 0 and held and (held[-1][keys].iloc[-1] == batch[keys].iloc[0]).all():
                held.append(batch)
                continue
            whole = pd.concat([*held, batch.iloc[:cut]])
            if len(whole):
                yield work(whole.reset_index(drop=True))
            held = [batch.iloc[cut:]]
        if held:
            yield work(pd.concat(held).reset_index(drop=True))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def group_numbers(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = (rows[keys] != rows[keys].shift()).any(axis=1).to_numpy()
    return np.cumsum(new)


def rooted(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each one's component, for links between a and b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root


def likely_links(rows: pd.DataFrame, similar: float) -> pd.DataFrame:
    """(a, b): a spanning forest of the pairs in each bucket whose signatures and sizes allow them."""
    group = group_numbers(rows, ["tree", "bucket", "low", "high"])
    signature = np.frombuffer(b"".join(rows["signature"]), np.uint8).reshape(len(rows), -1)
    n, hashes = rows["n"].to_numpy(), signature.shape[1]
    least = hashes * (similar - ERRORS * np.sqrt(similar * (1 - similar) / hashes))
    left, right = [], []
    at = np.arange(len(rows))
    for shift in range(1, len(rows)):
        at = at[at + shift < len(rows)]
        at = at[group[at] == group[at + shift]]
        if not len(at):
            break
        small, large = np.minimum(n[at], n[at + shift]), np.maximum(n[at], n[at + shift])
        some = at[small >= similar * large - 1e-9]
        hit = some[(signature[some] == signature[some + shift]).sum(axis=1) >= least]
        left.append(hit)
        right.append(hit + shift)
    root = rooted(len(rows), *(np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (left, right)))
    keys, linked = rows["key"].to_numpy(), np.flatnonzero(root != np.arange(len(rows)))
    return pd.DataFrame({"a": keys[linked], "b": keys[root[linked]]})


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share; only shingles of several sets are looked at."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(n > 1) - 1
    keep = n[place] > 1
    owner, column = owner[keep], number[place[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, (1 << 23) // len(sets))
    for start in range(0, int((n > 1).sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        dense = np.zeros((len(sets), width), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        total += dense @ dense.T
    return total.round().astype(np.int64)


def verified(rows: pd.DataFrame, similar: float) -> pd.DataFrame:
    """(key, other, links): for each set of a block its links by exact similarity (in documents), and
    a set that leads to all it is linked with."""
    out = []
    for _, block in rows.groupby(["root", "low", "high"], sort=False):
        sets = [np.frombuffer(s, "<u8") for s in block["shingles"]]
        n, part = np.array([len(s) for s in sets]), block["part"].to_numpy()
        shared = intersections(sets)
        # Integers on both sides up to the last step, as the threshold itself counts.
        linked = shared >= similar * (n[:, None] + n[None, :] - shared) - 1e-9
        if (block["low"] != block["high"]).iloc[0]:
            linked &= part[:, None] != part[None, :]
        np.fill_diagonal(linked, False)
        a, b = np.nonzero(np.triu(linked))
        root, keys = rooted(len(sets), a, b), block["key"].to_numpy()
        links = linked @ block["copies"].to_numpy()
        hit = np.flatnonzero(links > 0)
        out.append(pd.DataFrame({"key": keys[hit], "other": keys[root[hit]], "links": links[hit]}))
    return pd.concat(out)


def similar_documents(
    docs: DataFrame, ident: str, text: str, words: int = WORDS, similar: float = SIMILAR, trees: int = TREES, recall: float = RECALL
) -> DataFrame:
    """(<ident>, class_id, links, copies) for each row of ``docs``.

    Texts are sets of runs of ``words`` words; two are linked if the sets' Jaccard similarity is
    ``similar`` or more. ``links`` is the number of other rows a row is linked with, ``copies`` the
    number of rows with its very set, and ``class_id`` the smallest id that can be reached over
    links (null only if all ids there are null). Texts of fewer words are one run of all of them; null
    texts and texts without words are linked with nothing and are their own class. Repeated rows are
    copies. Other columns are not looked at. An empty table gives no rows.

    Rows with equal sets are one class from the start. Their signatures are cut into ``trees`` bands of
    the depth at which the recall is reached, and sets that share a band (prefix) and whose
    signatures allow a link are joined to neighbourhoods. In these the whole sets are compared
    exactly, in blocks: larger buckets and neighbourhoods are dealt over pairs of parts, counts and
    a spanning forest leave a block, never its pairs.
    """
    depth = prefix_depth(similar, trees, recall)
    rows = stage(sketches(docs, ident, text, words, trees, depth), "sketches")
    classes = stage(
        rows.where("n > 0").groupBy("key").agg(
            F.count("*").alias("copies"), F.min("id").alias("first"), F.first("n").alias("n"),
            F.first("prefixes").alias("prefixes"), F.first("signature").alias("signature"),
        ),
        "set-classes",
    )
    leaves = classes.select("key", F.posexplode("prefixes").alias("tree", "bucket"))
    shared = stage(
        leaves.groupBy("tree", "bucket").agg(F.count("*").alias("m")).where("m > 1"), "shared-prefixes"
    )
    members = stage(leaves.join(shared, ["tree", "bucket"]), "prefix-members")
    dealt = dealt_over(
        members.join(classes.select("key", "n", "signature"), "key"), F.ceil(F.col("m") / BUCKET_ROWS)
    ).select("tree", "bucket", "low", "high", "key", "n", "signature")
    likely = by_groups(
        dealt, ["tree", "bucket", "low", "high"], lambda g: likely_links(g, similar), "a binary, b binary"
    )
    near = stage(components(likely).join(classes.select(F.col("key").alias("node"), "copies", "n"), "node"), "neighbourhoods")
    sizes = near.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).alias("parts")
    )
    wanted = stage(near.join(sizes, "root").select(F.col("node").alias("key"), "root", "copies", "parts"), "set-parts")
    blocks = dealt_over(sets_of(docs, text, words, wanted), F.col("parts"))
    exact = stage(
        by_groups(blocks, ["root", "low", "high"], lambda g: verified(g, similar), "key binary, other binary, links long"),
        "verified",
    )
    joined = components(exact.select("key", "other"))
    groups = joined.join(classes.select(F.col("key").alias("node"), "first"), "node")
    first = groups.groupBy("root").agg(F.min("first").alias("class_id"))
    found = (
        groups.join(first, "root").select(F.col("node").alias("key"), "class_id")
        .join(exact.groupBy("key").agg(F.sum("links").alias("links")), "key")
    )
    info = stage(
        classes.select("key", "copies", "first").join(found, "key", "left").where("copies > 1 or links > 0")
        .select("key", "copies", F.coalesce("class_id", "first").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links")),
        "class-links",
    )
    return rows.select("id", "key").join(info, "key", "left").select(
        F.col("id").alias(ident),
        F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def dealt_over(rows: DataFrame, parts) -> DataFrame:
    """A row for each pair of parts that its ``key`` is compared in: (low, high), and its own part."""
    rows = rows.withColumn("__parts", parts.cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.col("__parts")).cast("int"))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    return rows.withColumn("low", F.least("part", "__other")).withColumn("high", F.greatest("part", "__other"))
