"""Embedding near-duplicates by NN-descent.

A neighbour graph is seeded from leaves of random-projection orders and refined by joining the neighbours of
each vector with each other (neighbours of neighbours). Lists hold NEIGHBOURS entries; where a list may be
saturated with links, it is enlarged: the vectors of each component of links are compared with each other in
chunks, so every link inside a component counts, however large. An audit measures recall on bounded samples
against all vectors; while it is below ``recall`` lists grow to twice their length and the graph is refined again, and
if that doesn't help the run fails with the figure instead of returning a result that lacks links.

Only vectors of one label and one length are compared, by cosine in double precision. Equal vectors are
collapsed first, so copies cost nothing. Search tables carry the vectors; links are never all written out.

Defined cases: null labels, and vectors that are null, empty, zero or hold null or non-finite components, link
with nothing and stand alone; repeated rows are vectors of their own; null ids count as links of others but
name no component unless all ids are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.llm.common import runs, saved
from stratovox.operators.components import components

NEIGHBOURS, TREES, LEAF, ROUNDS = 6, 6, 128, 8
#: Vectors of a component, or of one neighbourhood, that are compared with as many others at once.
CHUNK = 1024
#: Vectors of each of the audit's two samples (of all vectors, and of those in components), which it compares with all others.
AUDITED = 512
_CODE_BITS = 24


def _unit(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def prepared(points: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(id, label, vec)``: the vector as bytes of doubles, null if it can't link."""

    def scan(batches):
        for batch in batches:
            out = []
            for x, label in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                vec = None
                if x and label is not None and None not in x:
                    v = np.array(x, np.float64)
                    if np.isfinite(v).all() and v.any():
                        vec = v.tobytes()
                out.append(vec)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "label", "vec"])

    rows = points.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    return rows.mapInArrow(scan, "id long, label string, vec binary")


def _best(members: list[int], vectors: list[bytes], keep: int, roots: np.ndarray | None = None):
    """(id, neighbour, cosine) of the ``keep`` nearest of each member among the members, or among those of other roots."""
    x = _unit(vectors)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    if roots is not None:
        sims[roots[:, None] == roots[None, :]] = -2
    k = min(keep, len(members) - 1)
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < len(members) - 1 else np.argsort(-sims, axis=1)[:, :k]
    ids = np.array(members, np.int64)
    out = np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(sims, near, 1).ravel()
    return out if roots is None else tuple(c[out[2] > -2] for c in out)


def _roots(run) -> np.ndarray | None:
    return run.column("root").to_numpy() if "root" in run.column_names else None


def _leaves(batches, n_keys: int, size: int):
    """Tables of up to ``size`` consecutive rows that agree in the first ``n_keys`` columns, from sorted batches; no run is held whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([c.to_numpy() for c in batch.columns[:n_keys]])
        cuts = [0, *(np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            key = tuple(keys[:, a].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            while a < b:
                step = min(b - a, size - sum(h.num_rows for h in held))
                held.append(batch.slice(a, step))
                a += step
                if sum(h.num_rows for h in held) == size:
                    yield pa.Table.from_batches(held)
                    held = []
    if held:
        yield pa.Table.from_batches(held)


def _edges(parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=["id", "nbr", "sim"])


def _batched(parts_of):
    """Join small edge lists into batches."""
    held, n = [], 0
    for part in parts_of:
        held.append(part)
        n += len(part[0])
        if n > 50_000:
            yield _edges(held)
            held, n = [], 0
    if held:
        yield _edges(held)


def _nearest(edges: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best distinct neighbours of each id."""
    best = edges.repartition("id").groupBy("id", "nbr").agg(F.max("sim").alias("sim"))
    rank = F.expr("row_number() over (partition by id order by sim desc, nbr)")
    return best.withColumn("r", rank).where(F.col("r") <= keep).select("id", "nbr", "sim")


def seeded(classes: DataFrame, keep: int = NEIGHBOURS) -> DataFrame:
    """A first graph: the nearest of each vector among LEAF vectors that follow each other in orders by random projections.

    Vectors are sorted by the signs of their projections, so a leaf shares as many signs as its density allows.
    Where ``classes`` have a ``root``, only neighbours of other roots count.
    """
    outside = ["root"] if "root" in classes.columns else []

    def code(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vecs = batch.column(2).to_pylist()
            out = np.zeros((len(vecs), TREES), np.int64)
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vecs):
                by_size.setdefault(len(v) // 8, []).append(i)
            for size, rows in by_size.items():
                if size not in planes:
                    planes[size] = np.random.default_rng(size).standard_normal((size, TREES * _CODE_BITS))
                signs = (_unit([vecs[i] for i in rows]) @ planes[size] > 0).reshape(len(rows), TREES, _CODE_BITS)
                out[rows] = signs @ (1 << np.arange(_CODE_BITS)[::-1])
            for t in range(TREES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(vecs), t, np.int32)), batch.column(1), pa.array(out[:, t]), batch.column(0), batch.column(2), *batch.columns[3:]],
                    names=["tree", "block", "code", "id", "vec", *outside],
                )

    coded = classes.select("id", "block", "vec", *outside).mapInArrow(code, "tree int, block long, code long, id long, vec binary" + ", root long" * len(outside))
    coded = coded.repartitionByRange("tree", "block", "code", "id").sortWithinPartitions("tree", "block", "code", "id")

    def leaves(batches):
        def parts():
            for run in _leaves(batches, 2, LEAF):
                if len(run) > 1:
                    yield _best(run.column("id").to_pylist(), run.column("vec").to_pylist(), keep, _roots(run))

        yield from _batched(parts())

    return _nearest(coded.mapInArrow(leaves, "id long, nbr long, sim double"), keep)


def refined(graph: DataFrame, classes: DataFrame, keep: int = NEIGHBOURS) -> DataFrame:
    """One round of NN-descent: everything that is a neighbour of one vector, or has it as neighbour, meets there.

    Where ``classes`` have a ``root``, only neighbours of other roots are returned.
    """
    outside = ["root"] if "root" in classes.columns else []
    members = graph.select(F.col("id").alias("centre"), F.col("nbr").alias("id")).union(graph.select(F.col("nbr"), F.col("id"))).union(classes.select("id", "id")).distinct()
    # a hub's neighbourhood is cut into chunks that meet two by two, in tasks of their own
    hubs = members.groupBy("centre").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("m")).where("m > 1")
    members = members.join(hubs, "centre", "left").withColumn("c", F.pmod(F.xxhash64("id"), F.coalesce("m", F.lit(1))).cast("int"))
    members = members.withColumn("x", F.explode(F.sequence(F.lit(0), F.coalesce("m", F.lit(1)) - 1)))
    members = members.select("centre", F.least("c", "x").alias("c1"), F.greatest("c", "x").alias("c2"), "id")
    gathered = members.join(classes.select("id", "vec", *outside), "id").select("centre", "c1", "c2", "id", "vec", *outside)
    gathered = gathered.repartition("centre", "c1", "c2").sortWithinPartitions("centre", "c1", "c2", "id")

    def local(batches):
        def parts():
            for run in runs(batches, 3):
                yield _best(run.column("id").to_pylist(), run.column("vec").to_pylist(), keep, _roots(run))

        yield from _batched(parts())

    found = gathered.mapInArrow(local, "id long, nbr long, sim double")
    return _nearest(found if outside else found.unionByName(graph), keep)


def joined(classes: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """``(node, root)``: the components of the links of ``graph`` and of the links between components.

    Where a list is full of members of its own component, links to others don't get into it. So the nearest neighbours
    outside of the own component are sought as well, and components joined by them, until no link leads out.
    """
    links = graph.where(F.col("sim") >= threshold).select(F.col("id").alias("a"), F.col("nbr").alias("b"))
    roots = components(links)
    while True:
        placed = saved(classes.select("id", "block", "vec").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")), "placed")
        around = saved(refined(graph.unionByName(seeded(placed)), placed), "outside")
        around = saved(refined(graph.unionByName(around), placed).unionByName(around), "outside")
        out = around.where(F.col("sim") >= threshold).select(F.col("id").alias("a"), F.col("nbr").alias("b"))
        if out.isEmpty():
            return roots
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(out)
        roots = components(links)


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def _chunked(own: DataFrame, threshold: float) -> DataFrame:
    """``root, c1, c2, c, id, copies, vec``: vectors of large components, once for each pair of chunks that may hold a link.

    Chunks follow the order of a random projection, so their vectors lie close together. Two chunks meet only if the angle
    between their centres is at most that of the threshold and both chunks' radii.
    """

    def cut(batches):
        first = TaskContext.get().partitionId() << 32
        for n, run in enumerate(_leaves(_projected(batches), 1, CHUNK)):
            yield from run.append_column("c", pa.array(np.full(len(run), first + n))).select(["root", "c", "id", "copies", "vec"]).to_batches()

    def _projected(batches):
        for batch in batches:
            yield batch.select(["root", "id", "copies", "vec"])

    def side(batches):
        for batch in batches:
            vecs = batch.column(3).to_pylist()
            out = np.zeros(len(vecs))
            for size in {len(v) for v in vecs}:
                at = [i for i, v in enumerate(vecs) if len(v) == size]
                out[at] = _unit([vecs[i] for i in at]) @ np.random.default_rng(size // 8).standard_normal(size // 8)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["root", "id", "copies", "vec", "side"])

    placed = own.select("root", "id", "copies", "vec").mapInArrow(side, "root long, id long, copies long, vec binary, side double")
    placed = placed.repartitionByRange("root", "side", "id").sortWithinPartitions("root", "side", "id")
    placed = saved(placed.mapInArrow(cut, "root long, c long, id long, copies long, vec binary"), "chunks")

    def centre(batches):
        for run in _leaves(batches, 2, CHUNK):
            x = _unit(run.column("vec").to_pylist())
            middle = x.mean(axis=0)
            middle /= max(1e-300, np.sqrt((middle * middle).sum()))
            row = [run.column("root")[0].as_py(), run.column("c")[0].as_py(), middle.tolist(), float(_angles(x, middle[None]).max())]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["root", "c", "middle", "radius"])

    found = placed.repartition("root", "c").sortWithinPartitions("root", "c").select("root", "c", "vec")
    found = saved(found.mapInArrow(centre, "root long, c long, middle array<double>, radius double"), "centres")
    one, two = (found.select("root", *(F.col(n).alias(f"{n}{k}") for n in ("c", "middle", "radius"))) for k in (1, 2))
    cosine = F.aggregate(F.zip_with("middle1", "middle2", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    reach = F.lit(float(np.arccos(min(1.0, threshold))) + 1e-6) + F.col("radius1") + F.col("radius2")
    pairs = one.join(two, "root").where((F.col("c1") <= F.col("c2")) & (F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) <= reach))
    pairs = saved(pairs.select("root", "c1", "c2"), "pairs")
    sides = pairs.select("root", "c1", "c2", F.explode(F.array_distinct(F.array("c1", "c2"))).alias("c"))
    return placed.join(sides, ["root", "c"]).select("root", "c1", "c2", "c", "id", "copies", "vec")


def component_links(classes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """``(id, links)``: for every class of a component, the vectors of others that it links with; the lists of saturated vectors
    are enlarged to the whole component, whose chunks are compared two by two."""
    sizes = roots.groupBy("root").agg((F.count("*") + 1).alias("n"))
    members = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    own = members.join(sizes, "root").join(classes.select(F.col("id").alias("node"), "copies", "vec"), "node").withColumnRenamed("node", "id")
    zero = F.lit(0).cast("long")
    jobs = own.where(F.col("n") <= CHUNK).select("root", zero.alias("c1"), zero.alias("c2"), zero.alias("c"), "id", "copies", "vec")
    large = own.where(F.col("n") > CHUNK)
    if not large.isEmpty():
        jobs = jobs.unionByName(_chunked(large, threshold))
    jobs = jobs.repartition("root", "c1", "c2").sortWithinPartitions("root", "c1", "c2", "id")

    def count(batches):
        held_ids, held_links = [], []
        for run in runs(batches, 3):
            c1, c2 = run.column("c1")[0].as_py(), run.column("c2")[0].as_py()
            ids, chunk, copies = run.column("id").to_numpy(), run.column("c").to_numpy(), run.column("copies").to_numpy()
            x, links = _unit(run.column("vec").to_pylist()), np.zeros(len(ids), np.int64)
            if c1 == c2:
                linked = x @ x.T >= threshold
                np.fill_diagonal(linked, False)
                links = linked @ copies
            else:
                a, b = np.nonzero(chunk == c1)[0], np.nonzero(chunk == c2)[0]
                linked = x[a] @ x[b].T >= threshold
                links[a], links[b] = linked @ copies[b], linked.T @ copies[a]
            held_ids.append(ids)
            held_links.append(links)
            if len(held_ids) > 2000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held_ids)), pa.array(np.concatenate(held_links))], names=["id", "links"])
                held_ids, held_links = [], []
        if held_ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held_ids)), pa.array(np.concatenate(held_links))], names=["id", "links"])

    return jobs.mapInArrow(count, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def audited(classes: DataFrame, links: DataFrame, threshold: float) -> float:
    """Mean over sampled classes that have links of the share of their links that was found, by comparison with all vectors.

    Two samples of AUDITED classes with the least id hashes: one of all classes, one of those with links, so that a table
    with few links is audited on some as well. Every class counts once, whatever the size of its group.
    """
    few = lambda df: df.orderBy(F.xxhash64("id"), "id").limit(AUDITED).select("id", "block", "vec").collect()
    by_block: dict[int, dict] = {}
    for r in [*few(classes), *few(classes.join(links.where("links > 0").select("id"), "id"))]:
        by_block.setdefault(r.block, {})[r.id] = bytes(r.vec)
    shipped = classes.sparkSession.sparkContext.broadcast(by_block)

    def count(batches):
        blocks = {k: (np.array(list(v)), _unit(list(v.values()))) for k, v in shipped.value.items()}
        for batch in batches:
            ids, block, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            vecs = batch.column(3).to_pylist()
            for k, (asked, x) in blocks.items():
                at = np.nonzero(block == k)[0]
                for i in range(0, len(at), 4096):
                    part = at[i : i + 4096]
                    linked = x @ _unit([vecs[j] for j in part]).T >= threshold
                    linked &= asked[:, None] != ids[part][None, :]
                    yield pa.RecordBatch.from_arrays([pa.array(asked), pa.array(linked @ copies[part])], names=["id", "wanted"])

    true = classes.select("id", "block", "copies", "vec").mapInArrow(count, "id long, wanted long").groupBy("id").agg(F.sum("wanted").alias("wanted"))
    share = F.least("wanted", F.coalesce("links", F.lit(0))) / F.col("wanted")
    found = true.where("wanted > 0").join(links, "id", "left").agg(F.avg(share).alias("recall")).first().recall
    return 1.0 if found is None else found


def near_duplicates(points: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98,
                    recall: float = 0.99, rounds: int = ROUNDS) -> tuple[DataFrame, float]:
    """``(id, n_links, component)`` for every vector, and the audited recall.

    Raises RuntimeError if the audit is below ``recall`` after ``rounds`` (at least one) rounds of refinement.
    ``n_links``: other vectors with a cosine of ``threshold`` or more; ``component``: the least id reachable over links.
    """
    rows = saved(prepared(points, id_col, vector_col, label_col), "vectors")
    key = F.xxhash64("label", F.length("vec"))
    named = rows.where("vec is not null").groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = saved(named.select(F.monotonically_increasing_id().alias("id"), key.alias("block"), "label", "least", "copies", "vec"), "classes")
    keep, graph = NEIGHBOURS, saved(seeded(classes), "graph")
    graph = saved(refined(graph, classes, keep), "graph")
    for _ in range(rounds):
        graph = saved(refined(graph, classes, keep), "graph")
        roots = joined(classes, graph, threshold)
        links = saved(component_links(classes, roots, threshold), "links")
        found = audited(classes, links, threshold)
        if found >= recall:
            break
        keep *= 2
    else:
        raise RuntimeError(f"recall is {found:.4f} after {rounds} rounds, the goal is {recall}")
    placed = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = (
        placed.join(least, "root").join(links, "id", "left")
        .select(F.col("label").alias("l"), F.col("vec").alias("v"), "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    out = rows.join(named, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v")), "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component")), found
