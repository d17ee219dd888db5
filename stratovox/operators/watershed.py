"""Watershed of affinities by steepest ascent, over a whole volume.

A voxel's steepest directions (those of its greatest affinity, and all of affinities that are high enough) form a mask of six bits. A direction is
mutual if the neighbour points back: mutual voxels form plateaus. A plateau with a corner, a voxel that also points to a
higher neighbour, is divided by the number of hops from its corners; one without is the
core of a basin. Then every voxel outside the cores has one direction, and basins are the components of directions and cores.

Voxels are dealt once, to blocks that hold two voxels of those around them; from then on a block is a row of arrays. Hops are counted inside of blocks,
which then tell each other the counts on their faces until none changes, so rounds grow with the blocks that a plateau's hops cross. Parts
of basins are found in blocks too, and which of them touch; only voxels at faces link them.

Of several directions of equal right the last one is taken, in the order z, y, x down and then z, y, x up. Plateau voxels with two corners
equally near go that way too, where a queue goes by the order of visits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.operators.components import components, forest, grouped, linked, named
from stratovox.plans.scratch import saved
from stratovox.sources.volumes import AXES

#: Directions: axis and side; the opposite of direction d is (d + 3) % 6.
DIRECTIONS = [(a, -1) for a in AXES] + [(a, 1) for a in AXES]
#: Voxels of a side of a block, and hops of what no corner reaches.
SIDE, FAR = 32, 1 << 30
BLOCK = [f"b{a}" for a in AXES]
_PLACE = ", ".join(f"{b} int" for b in BLOCK)
_STATE = f"{_PLACE}, set_ binary, mutual_ binary, here_ binary, hops_ binary, changed_ boolean, tells_ array<struct<{_PLACE}, side_ int, face_ binary>>"
_COLUMNS = [*BLOCK, "set_", "mutual_", "here_", "hops_", "changed_", "tells_"]


def _near(array: np.ndarray, d: int, edge: int = 0) -> np.ndarray:
    """Each place's neighbour in direction ``d``, of an array with ``edge`` more places on all sides than what is returned; ``edge`` 0: of the
    array itself, with 0 outside of it."""
    if not edge:
        array, edge = np.pad(array, 1), 1
    shift = [0, 0, 0]
    shift[d % 3] = -1 if d < 3 else 1
    return array[tuple(slice(edge + k, n - edge + k) for k, n in zip(shift, array.shape))]


def _plane(d: int) -> tuple:
    """The outermost places of a block in direction ``d``."""
    at: list = [slice(None)] * 3
    at[d % 3] = 0 if d < 3 else -1
    return tuple(at)


def _steepest(values: list[np.ndarray], here: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the steepest directions, and of those to which a neighbour points back, of a block that has two places more on all sides.

    ``values``: for each axis the affinity to the voxel before. Edges to voxels without a row count as ``low``; a voxel whose greatest affinity isn't
    above ``low`` has no direction.
    """
    inner = (slice(1, -1),) * 3
    linked_ = [np.pad((here & np.roll(here, 1, k))[tuple(slice(1, None) if j == k else slice(None) for j in range(3))], [(1, 0) if j == k else (0, 0) for j in range(3)]) for k in range(3)]
    down = [np.where(ok, v, low) for ok, v in zip(linked_, values)]
    edges = [v[inner] for v in down] + [_near(v, k + 3, 1) for k, v in enumerate(down)]
    there = [v[inner] for v in linked_] + [_near(v, k + 3, 1) for k, v in enumerate(linked_)]
    most = np.maximum.reduce(edges)
    mask = np.zeros(most.shape, np.uint8)
    for d, (e, ok) in enumerate(zip(edges, there)):
        mask[ok & (most > low) & ((e == most) | (e >= high))] |= 1 << d
    mutual = np.zeros(mask[inner].shape, np.uint8)
    for d in range(6):
        mutual |= (mask[inner] >> d & _near(mask, d, 1) >> (d + 3) % 6 & 1) << d
    return mask[inner], mutual


def _spread(hops: np.ndarray, mutual: np.ndarray) -> None:
    """Counts of hops (in place) go on over the mutual directions of a block until none changes."""
    ways = [(mutual >> d & 1).astype(bool) for d in range(6)]
    while True:
        found = hops.copy()
        for d, way in enumerate(ways):
            beyond = _near(hops, d)
            np.minimum(found, beyond + 1, out=found, where=way & (beyond < FAR) & _inside(d, len(hops)))
        if (found == hops).all():
            return
        hops[:] = found


def _inside(d: int, side: int) -> np.ndarray:
    """Where a block's places have their neighbour in direction ``d`` in the block."""
    out = np.ones((side,) * 3, bool)
    out[_plane(d)] = False
    return out


def _arrays(row, side: int) -> tuple[np.ndarray, ...]:
    """A block's masks, its voxels and its hops (a copy)."""
    kinds = (("set_", np.uint8), ("mutual_", np.uint8), ("here_", bool), ("hops_", np.int32))
    return tuple(np.frombuffer(row[c], k).reshape((side,) * 3).copy() for c, k in kinds)


def _tells(block: list[int], mutual: np.ndarray, hops: np.ndarray) -> list[dict]:
    """What a block's neighbours have to know: the hops on each face over which a plateau goes on."""
    out = []
    for d in range(6):
        if (mutual[_plane(d)] >> d & 1).any():
            home = [b + DIRECTIONS[d][1] * (k == d % 3) for k, b in enumerate(block)]
            out.append({**dict(zip(BLOCK, home)), "side_": (d + 3) % 6, "face_": np.ascontiguousarray(hops[_plane(d)]).tobytes()})
    return out


def _blocks(volume: DataFrame, affinities: dict[str, str], low: float, high: float, side: int, keep: bool) -> DataFrame:
    """A row for each block that has voxels: its masks, and hops as far as its own corners tell; if ``keep``, ``values_``: of each axis the
    affinities and which of them are null."""
    columns = sorted(set(affinities.values()))
    # a missing affinity counts as low
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float(low))).alias(f"v_{c}") for c in columns] + [F.col(c).isNull().alias(f"null_{c}") for c in columns if keep]
    names = [*_COLUMNS, *(["values_"] if keep else [])]
    dealt = volume.select(*(F.col(a).cast("int").alias(a) for a in AXES), *values)
    for a in AXES:
        own, place = F.floor(F.col(a) / side).cast("int"), F.pmod(F.col(a), F.lit(side))
        before = (place < 2) & ((own != 0) if a != "z" else F.lit(True))
        dealt = dealt.withColumn(f"b{a}", F.explode(F.when(before, F.array(own, own - 1)).when(place >= side - 2, F.array(own, own + 1)).otherwise(F.array(own))))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        block = [int(part[b].iloc[0]) for b in BLOCK]
        at = tuple(part[a].to_numpy() - b * side + 2 for a, b in zip(AXES, block))
        here, own = np.zeros((side + 4,) * 3, bool), (slice(2, -2),) * 3
        here[at] = True
        if not here[own].any():
            return pd.DataFrame(columns=names, dtype=object)
        filled, kept = {}, {}
        for c in columns:
            filled[c] = np.full(here.shape, float(low))
            filled[c][at] = part[f"v_{c}"].to_numpy()
            if keep:
                null = np.zeros(here.shape, bool)
                null[at] = part[f"null_{c}"].to_numpy()
                kept[c] = filled[c][own].tobytes() + null[own].tobytes()
            filled[c][np.isnan(filled[c])] = np.inf  # Spark's order has NaN as the greatest
        mask, mutual = _steepest([filled[affinities[a]] for a in AXES], here, low, high)
        hops = np.where(mask != mutual, 0, FAR).astype(np.int32)
        _spread(hops, mutual)
        row = [*block, mask.tobytes(), mutual.tobytes(), here[own].tobytes(), hops.tobytes(), True, _tells(block, mutual, hops)]
        return pd.DataFrame([[*row, [kept[affinities[a]] for a in AXES]] if keep else row], columns=names)

    return dealt.groupBy(*BLOCK).applyInPandas(run, f"{_STATE}, values_ array<binary>" if keep else _STATE)


def _faces(state: DataFrame) -> DataFrame:
    """For each block's neighbours the hops on the face that they share; ``side_``: in which direction of the neighbour it lies."""
    return state.select(F.explode("tells_").alias("t")).select("t.*")


def _heard(state: DataFrame, faces: DataFrame, side: int) -> DataFrame:
    """The blocks after what their neighbours told them; ``changed_``: whether that brought fewer hops."""

    def run(blocks: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return pd.DataFrame(columns=_COLUMNS, dtype=object)
        mask, mutual, here, hops = _arrays(blocks.iloc[0], side)
        before = hops.copy()
        for d, face in zip(told["side_"], told["face_"]):
            at, beyond = _plane(d), np.frombuffer(face, np.int32).reshape(side, side)
            way = (mutual[at] >> d & 1).astype(bool) & (beyond < FAR)
            hops[at] = np.where(way, np.minimum(hops[at], beyond + 1), hops[at])
        changed = bool((hops != before).any())
        if changed:
            _spread(hops, mutual)
        tells = _tells([int(blocks[b].iloc[0]) for b in BLOCK], mutual, hops)
        return blocks.assign(hops_=[hops.tobytes()], changed_=changed, tells_=[tells])[_COLUMNS]

    return state.drop("tells_").groupBy(*BLOCK).cogroup(faces.groupBy(*BLOCK)).applyInPandas(run, _STATE)


class _Parts:
    """The parts of basins in a block: ``local``, the least index of its part for each voxel, and ``far``, that of the part that leads to each of the
    voxels ``foreign`` of other blocks."""

    def __init__(self, row, told: pd.DataFrame, size: tuple[int, int], side: int):
        self.mask, mutual, self.here, hops = _arrays(row, side)
        around = np.full((side + 2,) * 3, FAR, np.int32)
        around[1:-1, 1:-1, 1:-1] = hops
        for d, face in zip(told["side_"], told["face_"]):
            at: list = [slice(1, -1)] * 3
            at[d % 3] = 0 if d < 3 else -1
            around[tuple(at)] = np.frombuffer(face, np.int32).reshape(side, side)
        self.place = [k + int(row[b]) * side for k, b in zip(np.indices(hops.shape), BLOCK)]
        self.index = index = (self.place[0].astype(np.int64) * size[0] + self.place[1]) * size[1] + self.place[2] + 1
        steps = _steps(size)
        onward, way = self.mask ^ mutual, np.full(hops.shape, -1, np.int8)
        ends = []
        for d in range(6):
            back, beyond = (mutual >> d & 1).astype(bool), _near(around, d, 1)
            way[np.where(onward != 0, (onward >> d & 1).astype(bool), back & (hops < FAR) & (beyond == hops - 1))] = d
            core = back & (hops == FAR)
            ends.append((index[core], index[core] + steps[d], _inside(d, side)[core]))
        for d in range(6):
            at = way == d
            ends.append((index[at], index[at] + steps[d], _inside(d, side)[at]))
        a, b, inside = (np.concatenate(c) for c in zip(*ends))
        nodes, roots = forest(a, b)
        self.local = index[self.here]
        self.foreign = np.unique(b[~inside])
        self.far = roots[np.searchsorted(nodes, self.foreign)]
        if len(nodes):
            found = np.minimum(np.searchsorted(nodes, self.local), len(nodes) - 1)
            self.local = np.where(nodes[found] == self.local, roots[found], self.local)


def _steps(size: tuple[int, int]) -> list[int]:
    """What a step in each direction adds to a voxel's index."""
    return [way * s for way in (-1, 1) for s in (size[0] * size[1], size[1], 1)]


def _parts(state: DataFrame, faces: DataFrame, size: tuple[int, int], side: int) -> DataFrame:
    """``z, y, x, index_, on_, root_, kind_``: each voxel and the least index of its basin's part in the block. Kinds: 1 at a face of the block, 2 a voxel of
    another block to which one of this block leads, else 0."""

    def run(blocks: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return pd.DataFrame({c: [] for c in (*AXES, "index_", "on_", "root_", "kind_")})
        p = _Parts(blocks.iloc[0], told, size, side)
        border = ~np.logical_and.reduce([_inside(d, side) for d in range(6)])
        none = np.zeros(len(p.foreign), np.int32)
        columns = {a_: np.concatenate([k[p.here], none]) for a_, k in zip(AXES, p.place)}
        columns |= {"index_": np.concatenate([p.index[p.here], p.foreign]), "on_": np.concatenate([p.mask[p.here] != 0, none == 0]), "root_": np.concatenate([p.local, p.far])}
        return pd.DataFrame(columns | {"kind_": np.concatenate([border[p.here].astype(np.int32), none + 2])})

    return state.drop("tells_").groupBy(*BLOCK).cogroup(faces.groupBy(*BLOCK)).applyInPandas(run, "z int, y int, x int, index_ long, on_ boolean, root_ long, kind_ int")


def _touching(state: DataFrame, faces: DataFrame, size: tuple[int, int], side: int) -> DataFrame:
    """``u, v, low, high, total, faces, beyond_``: of each two touching parts of a block what the affinities between them are; ``beyond_``: ``v`` isn't a part
    but the index of a voxel of the block before, and ``u`` what touches it. ``state`` has ``values_``."""

    def run(blocks: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return pd.DataFrame({c: [] for c in ("u", "v", "low", "high", "total", "faces", "beyond_")})
        p = _Parts(blocks.iloc[0], told, size, side)
        part = np.zeros((side,) * 3, np.int64)
        part[p.here] = p.local
        part[p.mask == 0] = 0
        within, across = [], []
        for k, data in enumerate(blocks["values_"].iloc[0]):
            value, null = np.frombuffer(data, np.float64, side**3).reshape(part.shape), np.frombuffer(data, bool, side**3, 8 * side**3).reshape(part.shape)
            before = _near(part, k)
            at = (part != 0) & (before != 0) & (part != before) & ~null
            within.append((np.minimum(part, before)[at], np.maximum(part, before)[at], value[at]))
            plane = _plane(k)
            at = (part[plane] != 0) & ~null[plane] & ((p.place[k][plane] > 0) if k else True)  # a row begins after the end of another
            across.append((part[plane][at], p.index[plane][at] + _steps(size)[k], value[plane][at]))
        out = []
        for beyond, ends in ((False, within), (True, across)):
            u, v, value = (np.concatenate(c) for c in zip(*ends))
            order = np.lexsort((v, u))
            u, v, value = u[order], v[order], value[order]
            starts = np.nonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])]))[0] if len(u) else np.zeros(0, np.int64)
            stats = [f.reduceat(value, starts) if len(u) else value for f in (np.fmin, np.maximum, np.add)]
            out.append(pd.DataFrame({"u": u[starts], "v": v[starts], **dict(zip(("low", "high", "total"), stats)), "faces": np.diff(np.append(starts, len(u))), "beyond_": beyond}))
        return pd.concat(out)

    return state.drop("tells_").groupBy(*BLOCK).cogroup(faces.groupBy(*BLOCK)).applyInPandas(run, "u long, v long, low double, high double, total double, faces long, beyond_ boolean")


def basin_parts(volume: DataFrame, affinities: dict[str, str], low: float = 0.0, high: float = 1.0, size: tuple[int, int] | None = None, side: int = SIDE, edges: bool = False) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The voxels with the parts of basins that blocks hold (``z, y, x, on_, root_``), the basins' names of these (``node, root``; others keep theirs), and if
    ``edges`` those of touching parts, ``u, v, low, high, total, faces`` (repeated between blocks; also of parts of one basin)."""
    if size is None:
        found = volume.agg(F.max("y").alias("y"), F.max("x").alias("x")).first()
        size = ((found.y or 0) + 1, (found.x or 0) + 1)
    first = saved(_blocks(volume, affinities, low, high, side, edges), "blocks")
    state = first.select(*_COLUMNS)
    while not (moved := state.where("changed_")).isEmpty():
        state = saved(_heard(state, _faces(moved), side), "blocks")
    found = saved(_parts(state, _faces(state), size, side), "parts")
    roots = components(linked(grouped(found.where("on_ and kind_ > 0"), "index_", "root_")), "u", "v")
    kinds, touching = dict(volume.dtypes), None
    if edges:
        both = saved(_touching(state.join(first.select(*BLOCK, "values_").hint("merge"), BLOCK), _faces(state), size, side), "touching")
        ends = found.where("on_ and kind_ = 1").select(F.col("index_").alias("v"), "root_")
        across = both.where("beyond_").join(ends.hint("merge"), "v").withColumn("v", F.col("root_"))
        columns = ["u", "v", "low", "high", "total", "faces"]
        touching = both.where("not beyond_").select(*columns).unionByName(across.select(*columns))
    return found.where("kind_ < 2").select(*(F.col(a).cast(kinds[a]).alias(a) for a in AXES), "on_", "root_"), roots, touching


def affinity_watershed(volume: DataFrame, affinities: dict[str, str], low: float = 0.0, high: float = 1.0, size: tuple[int, int] | None = None, side: int = SIDE) -> DataFrame:
    """``z, y, x, basin``: the basin of each voxel, named by its least linear index plus 1; 0 without an affinity above ``low``.

    ``affinities``: a column for each axis, of the edge to the voxel before. Missing rows of the volume are no voxels, a null counts as ``low``.
    ``labels.compacted`` numbers basins 1..n in the order of their first voxels. ``size``: rows and columns
    of a slice, by default those that occur; ``side``: voxels of a side of a block. An empty volume gives an empty result.
    """
    parts, roots, _ = basin_parts(volume, affinities, low, high, size, side)
    return named_parts(parts, roots).withColumnRenamed("id", "basin")


def named_parts(parts: DataFrame, names: DataFrame) -> DataFrame:
    """``z, y, x, id``: the voxels of :func:`basin_parts` by the names (``node, root``) of their parts, 0 without an affinity."""
    return named(parts, "root_", names).select(*AXES, F.when(F.col("on_"), F.col("root")).otherwise(F.lit(0)).cast("long").alias("id"))
