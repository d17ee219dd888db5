"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Fingerprints are compared with numpy exclusive-or and bit counts, tile against tile. A tile holds
fingerprints of equal population counts; two tiles whose counts differ by more than the radius can't
hold a link and never meet. Counts are kept per 16-bit lane (their sum is the population count), which
skips about 95 % of the tile pairs of random fingerprints at radius 3 where the plain count skips half.

Defined cases: null and empty texts have fingerprint 0 and link like any other; repeated rows share a
fingerprint and a component; a null id never names a component unless all ids of it are null; an empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.llm.buckets import agreeing, bucket_links
from stratovox.llm.common import LOWER, place_map, saved
from stratovox.llm.forest import Forest, close_pairs, thinned
from stratovox.llm.groups import linked_groups
from stratovox.operators.components import components

SEED = 42
#: Fingerprints in a tile at most (a tile is a binary value of eight bytes for each).
TILE = 2048
LANES = 4
#: Minimum hashes of a sketch (16 bits each), those of a band, and how many of the first JUDGED a candidate pair must share
#: in their low byte. At a similarity of 0.8 one pair in 600 shares no band, and one in 2,000 fewer than SHARED.
SKETCH, BAND, JUDGED, SHARED = 48, 4, 32, 18
#: Bits in which the SimHashes of a candidate pair may differ.
WIDE = 22
#: Documents of a group that one task compares with as many others at once.
CHUNK = 512
_ODD = np.random.default_rng(1).integers(0, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
_BIAS = 16  # keeps a neighbour's lane count from borrowing from the next lane


def shingle_hashes(text: bytes | None, words_each: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; of the whole sequence if it is shorter."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - words_each + 1)
    joined = map(b" ".join, zip(*(words[i:] for i in range(words_each)))) if len(words) >= words_each else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in joined), np.uint64, n)


def fingerprint(text: bytes | None, words_each: int = 3) -> int:
    """A bit is 1 if it is set in over half the hashes of the text's shingles."""
    hashes = shingle_hashes(text, words_each)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.unpackbits(hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 3) -> DataFrame:
    """``(id, fp)`` for every row of ``docs``; ``fp`` is the fingerprint as a signed long."""

    def scan(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, words_each) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(scan, "id long, fp long")


def _lane_key(fp, lanes: int) -> F.Column:
    width = 64 // lanes
    key = F.lit(0).cast("int")
    for lane in range(lanes):
        part = F.shiftrightunsigned(fp, lane * width)
        count = F.bit_count(part.bitwiseAND(F.lit((1 << width) - 1)) if lanes > 1 else part)
        key = F.shiftleft(key, 7).bitwiseOR(count + _BIAS)
    return key.cast("int")


def _neighbour_offsets(radius: int, lanes: int) -> list[int]:
    """Key differences of tiles that may hold links, one of each opposite two, zero included."""
    out = []
    for d in product(range(-radius, radius + 1), repeat=lanes):
        if sum(map(abs, d)) <= radius and d >= (0,) * lanes:
            value = 0
            for x in d:
                value = value * 128 + x
            out.append(value)
    return out


def _tiles(nodes: DataFrame, lanes: int) -> DataFrame:
    """``(key, first, data)``: fingerprints of one key, packed; equal ranges of the sorted table go to each task."""

    def pack(batches):
        held: list[np.ndarray] = []
        key = None

        def flush():
            if held:
                fps = np.concatenate(held)
                held.clear()
                for i in range(0, len(fps), TILE):
                    yield key, int(fps[i]), fps[i : i + TILE].tobytes()

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], names=["key", "first", "data"])

        for batch in batches:
            keys, fps = (c.to_numpy() for c in batch.columns)
            cuts = [0, *(np.nonzero(np.diff(keys))[0] + 1).tolist(), len(keys)]
            rows = []
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if key is not None and (keys[i] != key or sum(map(len, held)) >= TILE):
                    rows += flush()
                key = int(keys[i])
                held.append(fps[i:j])
            if rows:
                yield batch_of(rows)
        if held:
            yield batch_of(list(flush()))

    ranged = nodes.select(_lane_key(F.col("fp"), lanes).alias("key"), "fp").repartitionByRange("key", "fp").sortWithinPartitions("key", "fp")
    return ranged.mapInArrow(pack, "key int, first long, data binary")


def fingerprint_links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints (column ``fp``) within ``radius``, a spanning forest from each task.

    The forest has the components of all links; a group of k mutually close fingerprints gives at most k rows a task
    instead of k squared.
    """
    lanes = LANES if radius <= 3 else 1
    tiles = saved(_tiles(nodes, lanes).withColumn("tile", F.monotonically_increasing_id()), "tiles")
    left = tiles.select("tile", "data", "key", F.explode(F.array(*map(F.lit, _neighbour_offsets(radius, lanes)))).alias("o"))
    left = left.select("tile", "data", "o", (F.col("key") + F.col("o")).cast("int").alias("key"))
    right = tiles.select(F.col("tile").alias("tile_b"), F.col("data").alias("data_b"), "key")
    pairs = left.join(right, "key").where((F.col("o") != 0) | (F.col("tile") <= F.col("tile_b")))

    def compare(batches):
        forest = Forest()
        for batch in batches:
            for same, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = (a if same else np.concatenate([a, b])).view(np.int64)
                for x, y in close_pairs(a, b, radius, same):
                    x, y = thinned(x, y if same else y + len(a), len(both))
                    for u, v in zip(both[x].tolist(), both[y].tolist()):
                        forest.join(u, v)
        edges = forest.edges()
        for i in range(0, len(edges), 1 << 16):
            part = edges[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in part], pa.int64()), pa.array([e[1] for e in part], pa.int64())], names=["a", "b"])

    same = (F.col("o") == 0) & (F.col("tile") == F.col("tile_b"))
    return pairs.select(same.alias("same"), "data", "data_b").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 3, radius: int = 3) -> DataFrame:
    """``(id, fp, component)`` for every row: the fingerprint and the least id reachable over links.

    Fingerprints link at ``radius`` or fewer differing bits. Texts of one fingerprint are collapsed to one
    node before any comparison, so a group of copies of any size costs one node.
    """
    prints = saved(fingerprints(docs, id_col, text_col, words_each), "prints")
    reps = prints.groupBy("fp").agg(F.min("id").alias("rep"))
    roots = components(fingerprint_links(reps, radius))
    grouped = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("rep").alias("component"))
    named = grouped.join(least, "root").select("fp", "component")
    return prints.join(named, "fp").select("id", "fp", "component")


def sketch(shingles: np.ndarray) -> bytes:
    """16 bits of each of SKETCH minimum hashes; two texts share one with about the probability of their similarity."""
    low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1 << 12):
        part = shingles[None, i : i + (1 << 12)] * _ODD[:, None]
        low = np.minimum(low, (part ^ part >> np.uint64(31)).min(axis=1))
    return (low >> np.uint64(7)).astype(np.uint16).tobytes()


def described(docs: DataFrame, id_col: str, text_col: str, print_words: int, words_each: int) -> DataFrame:
    """``(doc, id, fp, sketch)`` of every text: its node id is its 64-bit hash."""

    def scan(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            fps = np.array([fingerprint(t, print_words) for t in texts], np.uint64).view(np.int64)
            sketches = [sketch(shingle_hashes(t, words_each)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps), pa.array(sketches, pa.binary())], names=["doc", "id", "fp", "sketch"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("id"), text.cast("binary").alias("t")).where("doc is not null")
    return rows.mapInArrow(scan, "doc long, id long, fp long, sketch binary")


def _candidate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of rows (a SimHash, then the judged bytes of a sketch) that are worth a comparison of their shingle sets."""
    close = np.bitwise_count(a[..., 0] ^ b[..., 0]) <= WIDE
    if close.any():
        at = np.nonzero(close)
        a, b = np.broadcast_arrays(a, b)
        close[at] = agreeing(a[at][..., 1:], b[at][..., 1:]) >= SHARED
    return close


def candidate_links(nodes: DataFrame) -> DataFrame:
    """``(a, b)``: links of nodes (``id, fp, sketch``) that share a band of their sketch, are within WIDE bits and share SHARED bytes.

    Within a band SimHashes are compared as in :func:`fingerprint_links`: by exclusive-or, in blocks by population count.
    """
    words = ["fp", *(f"w{k}" for k in range(JUDGED // 8))]

    def spread(batch: pa.RecordBatch):
        if batch.num_rows:
            low = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, SKETCH)
            judged = np.ascontiguousarray((low[:, :JUDGED] & 0xFF).astype(np.uint8)).view(np.int64)
            own, bands = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy(), judged]), low.view(np.uint64).reshape(-1, SKETCH // BAND)
            for k in range(bands.shape[1]):
                key = (bands[:, k] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) * np.uint64(0xC2B2AE3D27D4EB4F)
                yield np.column_stack([key.view(np.int64), own])

    return bucket_links(nodes.select("id", "fp", "sketch"), [spread], words, _candidate, lambda data: np.bitwise_count(data[:, 0]).astype(np.float64), lambda ones: ones + WIDE)


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words_each: int) -> DataFrame:
    """``wanted`` (columns doc and id, and others) with the sorted shingle hashes of each text."""
    shipped, place = place_map(wanted.select(F.col("doc").alias("a"), F.col("id").alias("b")))

    def scan(batches):
        for batch in batches:
            doc, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = np.nonzero(place.marked(shipped.value, doc, node))[0]
            for i in range(0, len(keep), 200):
                part = batch.take(pa.array(keep[i : i + 200]))
                sets = [np.unique(shingle_hashes(t, words_each)).view(np.int64) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets, pa.list_(pa.int64()))], names=["doc", "id", "shingles"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("id"), text.cast("binary").alias("t")).where("doc is not null")
    return wanted.join(rows.mapInArrow(scan, "doc long, id long, shingles array<long>").dropDuplicates(["doc", "id"]), ["doc", "id"])


def similar_sets(similarity: float):
    """Which texts of a run have this Jaccard similarity, for :func:`linked_groups`."""

    def opened(run: pa.Table):
        sets = [np.asarray(x.values) for x in run.column("shingles")]
        sizes = np.array([len(x) for x in sets])

        def near(i: int, later: np.ndarray):
            ratio = np.minimum(sizes[later], sizes[i]) / np.maximum(1, np.maximum(sizes[later], sizes[i]))
            close = ratio >= similarity if sizes[i] else sizes[later] == 0
            return later[close], ratio[close]

        held: dict[int, set] = {}

        def test(i: int, j: int) -> bool:
            if i not in held:
                if len(held) > 64:
                    held.clear()
                held[i] = set(sets[i].tolist())
            shared = len(held[i].intersection(sets[j].tolist()))
            return shared >= similarity * (sizes[i] + sizes[j] - shared)

        return near, test

    return opened


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 5, similarity: float = 0.8,
                   print_words: int = 3) -> DataFrame:
    """``(doc, id, keeper_doc, keeper_id)`` for every distinct id and text: the document of its group that stays.

    Texts are linked if the Jaccard similarity of their word shingles is at least ``similarity``. Candidates share a band of
    a shingle sketch, where their SimHashes are compared (:func:`candidate_links`); each link is verified on the whole
    shingle sets. The one that stays is the least document id of a group. Rows with a null id take no part.
    """
    found = saved(described(docs, id_col, text_col, print_words, words_each), "prints")
    nodes = found.groupBy("id").agg(F.min("doc").alias("doc"), F.min("fp").alias("fp"), F.min("sketch").alias("sketch"))
    nodes = saved(nodes, "nodes")
    roots = components(candidate_links(nodes)).withColumnRenamed("node", "id").withColumnRenamed("root", "g")
    sizes = roots.select("g").union(roots.select("g").distinct()).groupBy("g").agg(F.count("*").alias("n"))
    members = roots.union(roots.select(F.col("g").alias("id"), "g").distinct())
    wanted = saved(nodes.select("id", "doc").join(members, "id").join(sizes, "g"), "groups")
    rows = saved(shingle_sets(docs, wanted, id_col, text_col, words_each), "shingles")
    linked = linked_groups(rows, similar_sets(similarity), ["shingles"], CHUNK)
    rooted = nodes.select("id", "doc").join(linked, "id", "left").withColumn("root", F.coalesce("root", "id"))
    keeper = rooted.groupBy("root").agg(F.min(F.struct("doc", "id")).alias("keeper"))
    named = rooted.join(keeper, "root").select("id", F.col("keeper.doc").alias("keeper_doc"), F.col("keeper.id").alias("keeper_id"))
    return found.select("doc", "id").distinct().join(named, "id")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of :func:`similar_groups`; all columns stay, rows with a null id stay.

    Rows that share an id are documents of their own if their texts differ; of rows that repeat id and text one stays.
    """
    groups = similar_groups(docs, id_col, text_col, **options)
    lost = groups.where((F.col("doc") != F.col("keeper_doc")) | (F.col("id") != F.col("keeper_id"))).select(F.col("doc").alias("lost_doc"), F.col("id").alias("lost_id"))
    columns = [F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]
    at = f"c{docs.columns.index(id_col)}"
    rows = docs.select(*columns, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("hash_"))
    left = rows.join(lost, (rows[at].cast("long") == F.col("lost_doc")) & (F.col("hash_") == F.col("lost_id")), "left_anti")
    once = left.where(rows[at].isNotNull()).dropDuplicates([at, "hash_"]).unionByName(left.where(rows[at].isNull()))
    return once.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))
