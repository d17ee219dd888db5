"""Block grids, chunk grids, sliding windows and joins of boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratovox.sources.volumes import AXES


def shape(volume: DataFrame) -> DataFrame:
    """One row ``nz, ny, nx``: sizes from the greatest coordinates."""
    return volume.agg(*((F.max(a) + 1).alias(f"n{a}") for a in AXES))


def blocks(sizes: DataFrame, block: tuple[int, int, int], overlap: tuple[int, int, int]) -> DataFrame:
    """``idx`` and half-open bounds of blocks that start every block - overlap voxels; the last ones may be slivers."""
    out, index = sizes, F.lit(0).cast("long")
    for axis, b, o in zip(AXES, block, overlap):
        step = max(1, b - o)
        out = out.select("*", F.posexplode(F.sequence(F.lit(0), F.col(f"n{axis}") - 1, F.lit(step))).alias(f"i{axis}", f"{axis}1"))
        out = out.withColumn(f"{axis}2", F.least(F.col(f"{axis}1") + b, F.col(f"n{axis}")))
        index = index * F.ceil(F.col(f"n{axis}") / step) + F.col(f"i{axis}")
    return out.select(index.cast("long").alias("idx"), *(f"{a}{k}" for a in AXES for k in (1, 2)))


def chunks(sizes: DataFrame, chunk: tuple[int, int, int], overlap: tuple[int, int, int]) -> DataFrame:
    """Chunk coordinates and bounds; a chunk starts ``overlap`` before the end of the one before, and none starts once the end is reached."""
    out = sizes
    for axis, b, o in zip(AXES, chunk, overlap):
        step = b - o
        last = F.greatest(F.lit(0), F.ceil((F.col(f"n{axis}") - b) / step)).cast("int")
        out = out.select("*", F.explode(F.sequence(F.lit(0), last)).alias(f"c{axis}"))
        out = out.withColumn(f"{axis}1", F.col(f"c{axis}") * step).withColumn(f"{axis}2", F.least(F.col(f"c{axis}") * step + b, F.col(f"n{axis}")))
    return out.select(*(f"c{a}" for a in AXES), *(f"{a}{k}" for a in AXES for k in (1, 2)))


def _starts(position: Column, size: Column, b: int, step: int, last: Column) -> Column:
    """Indices of the blocks of one axis that hold a position: arithmetic, so no join with the grid is needed."""
    low = F.greatest(F.lit(0), F.ceil((position - (b - 1)) / step).cast("int"))
    return F.sequence(low, F.least(F.floor(position / step).cast("int"), last))


def in_blocks(volume: DataFrame, block: tuple[int, int, int], overlap: tuple[int, int, int]) -> DataFrame:
    """A row for each voxel and block (``idx``) that holds it; voxels in an overlap appear once a block."""
    out, index = volume.join(F.broadcast(shape(volume))), F.lit(0).cast("long")
    for axis, b, o in zip(AXES, block, overlap):
        step = max(1, b - o)
        n = F.ceil(F.col(f"n{axis}") / step).cast("int")
        out = out.withColumn(f"i{axis}", F.explode(_starts(F.col(axis), F.col(f"n{axis}"), b, step, n - 1)))
        index = index * n + F.col(f"i{axis}")
    return out.select(index.cast("long").alias("idx"), *volume.columns)


def in_chunks(volume: DataFrame, chunk: tuple[int, int, int], overlap: tuple[int, int, int]) -> DataFrame:
    """A row for each voxel and chunk that holds it, with the chunk's coordinates and the voxel's place inside it."""
    out = volume.join(F.broadcast(shape(volume)))
    for axis, b, o in zip(AXES, chunk, overlap):
        step = b - o
        last = F.greatest(F.lit(0), F.ceil((F.col(f"n{axis}") - b) / step)).cast("int")
        out = out.withColumn(f"c{axis}", F.explode(_starts(F.col(axis), F.col(f"n{axis}"), b, step, last)))
        out = out.withColumn(f"l{axis}", (F.col(axis) - F.col(f"c{axis}") * step).cast("int"))
    values = [c for c in volume.columns if c not in AXES]
    return out.select(*(f"c{a}" for a in AXES), *(f"l{a}" for a in AXES), *values)


def merged_chunks(parts: DataFrame, values: list[str], chunk: tuple[int, int, int], overlap: tuple[int, int, int]) -> DataFrame:
    """Voxels at their place in the volume; where chunks overlap the later one (by z, y, x) wins."""
    order = F.struct(*(f"c{a}" for a in AXES))
    place = [(F.col(f"c{a}") * (b - o) + F.col(f"l{a}")).cast("int").alias(a) for a, b, o in zip(AXES, chunk, overlap)]
    return parts.select(*place, order.alias("order"), *values).groupBy(*AXES).agg(*(F.max_by(v, "order").alias(v) for v in values))


def box_pairs(boxes: DataFrame, cell: tuple[int, int, int]) -> DataFrame:
    """``i, j`` and the common box of every two boxes (i < j) that share voxels.

    Boxes are dealt to the cells that they touch, and a pair counts in the cell of its common low corner only, so
    the join is on equal cells and gives each pair once.
    """
    bounds = [f"{a}{k}" for a in AXES for k in (1, 2)]
    dealt = boxes.select("idx", *bounds)
    for axis, size in zip(AXES, cell):
        dealt = dealt.withColumn(f"g{axis}", F.explode(F.sequence(F.floor(F.col(f"{axis}1") / size), F.floor((F.col(f"{axis}2") - 1) / size))))
    other = dealt.select(F.col("idx").alias("j"), *(F.col(c).alias(f"o{c}") for c in bounds), *(f"g{a}" for a in AXES))
    joined = dealt.withColumnRenamed("idx", "i").join(other, [f"g{a}" for a in AXES]).where("i < j")
    for axis, size in zip(AXES, cell):
        joined = joined.withColumn(f"low{axis}", F.greatest(f"{axis}1", f"o{axis}1")).withColumn(f"high{axis}", F.least(f"{axis}2", f"o{axis}2"))
        joined = joined.where((F.col(f"low{axis}") < F.col(f"high{axis}")) & (F.floor(F.col(f"low{axis}") / size) == F.col(f"g{axis}")))
    return joined.select("i", "j", *(F.col(f"{k}{a}").alias(f"{a}{n}") for a in AXES for n, k in ((1, "low"), (2, "high"))))


def running_before(rows: DataFrame, order: str, value: str, name: str, chunk: int = 4096, levels: int = 2) -> DataFrame:
    """Add the sum of ``value`` over all rows of smaller ``order`` (whole numbers): sums inside chunks of the order, then over the chunks in the
    same way, for ``levels`` levels; the last one is a single window over a ``chunk ** levels``-th of the order's range."""
    part = F.floor(F.col(order) / chunk)
    inside = Window.partitionBy("part_").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.withColumn("part_", part).withColumn("in_", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    totals = cut.groupBy("part_").agg(F.sum(value).alias("sum_"))
    carried = f"before{levels}_"
    if levels > 1:
        before = running_before(totals.withColumnRenamed("part_", "chunk_"), "chunk_", "sum_", carried, chunk, levels - 1).select(F.col("chunk_").alias("part_"), carried)
    else:
        across = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
        before = totals.select("part_", F.coalesce(F.sum("sum_").over(across), F.lit(0)).alias(carried))
    total = (F.col("in_") + F.col(carried)).cast("long")
    return cut.join(before, "part_").select(*(c for c in cut.columns if c not in ("part_", "in_")), total.alias(name))


def window_starts(sizes: DataFrame, window: tuple[int, int, int], stride: tuple[int, int, int]) -> DataFrame:
    """``pos`` and start of each sliding window; the last of an axis is moved back to end with the volume. None in a smaller volume."""
    out, index = sizes, F.lit(0).cast("long")
    for axis, w, s in zip(AXES, window, stride):
        count = (F.lit(1) + F.ceil((F.col(f"n{axis}") - w) / s)).cast("int")
        out = out.where(F.col(f"n{axis}") >= w).select("*", F.explode(F.sequence(F.lit(0), count - 1)).alias(f"i{axis}"))
        index = index * count + F.col(f"i{axis}")
        out = out.withColumn(axis, F.least(F.col(f"i{axis}") * s, F.col(f"n{axis}") - w).cast("int"))
    return out.select(index.cast("long").alias("pos"), *AXES)
