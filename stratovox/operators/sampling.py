"""Seeded samples of windows and of chunks: equal for equal seeds, however the tables are partitioned.

Random numbers are the first 52 bits of a digest of the seed and what the number is for, so a sample needs no state: any draw can be made
alone, by any task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratovox.sources.volumes import AXES


def uniform(seed: int, *parts: Column) -> Column:
    """A number of [0, 1) for the seed and the parts (whole numbers or text)."""
    text = F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def window_draws(volumes: DataFrame, window: tuple[int, int, int], stride: tuple[int, int, int], n: int, seed: int, tries: int = 1) -> DataFrame:
    """``slot, try, volume, z, y, x``: starts of ``n`` times ``tries`` windows, drawn with replacement from all windows of all volumes.

    ``volumes``: ``volume`` and its size ``nz, ny, nx``; a small table. A volume is drawn by its share of the windows, a start evenly. Volumes smaller than the
    window have none. Windows are counted, never listed.
    """
    counts = [F.greatest(F.floor((F.col(f"n{a}") - w) / s) + 1, F.lit(0)).cast("long") for a, w, s in zip(AXES, window, stride)]
    sized = volumes.select("volume", *(c.alias(f"c{a}") for a, c in zip(AXES, counts))).withColumn("windows", F.col("cz") * F.col("cy") * F.col("cx"))
    order = Window.orderBy("volume").rowsBetween(Window.unboundedPreceding, -1)
    sized = sized.where("windows > 0").withColumn("before", F.coalesce(F.sum("windows").over(order), F.lit(0)))
    total = sized.agg(F.sum("windows").alias("total"))
    slots = volumes.sparkSession.range(n * tries).select(F.expr(f"id div {tries}").alias("slot"), (F.col("id") % tries).cast("int").alias("try"))
    drawn = slots.join(F.broadcast(total)).withColumn("at", F.floor(uniform(seed, F.col("slot"), F.col("try")) * F.col("total")))
    held = F.broadcast(sized.select("volume", "before", "windows", "cy", "cx"))
    found = drawn.join(held, (F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("windows"))).withColumn("at", F.col("at") - F.col("before"))
    place = [F.expr("at div (cy * cx)"), F.expr("at div cx % cy"), F.expr("at % cx")]
    return found.select("slot", "try", "volume", *((p * s).cast("int").alias(a) for a, p, s in zip(AXES, place, stride)))


def first_accepted(draws: DataFrame, accepted: DataFrame) -> DataFrame:
    """``slot, try, volume, z, y, x, valid``: each slot's first draw whose window is in ``accepted`` (``volume, z, y, x``, repeats allowed); a slot without one keeps
    its last draw, not valid."""
    marked = draws.join(accepted.select("volume", *AXES).distinct().withColumn("valid", F.lit(True)), ["volume", *AXES], "left").withColumn("valid", F.coalesce("valid", F.lit(False)))
    rank = F.when(F.col("valid"), F.col("try")).otherwise(F.lit(1 << 30) - F.col("try"))
    best = marked.groupBy("slot").agg(F.min_by(F.struct("try", "volume", *AXES, "valid"), rank).alias("b"))
    return best.select("slot", "b.try", "b.volume", *(f"b.{a}" for a in AXES), "b.valid")


def weighted_sample(rows: DataFrame, key: list[str], weight: str, n: int, seed: int) -> DataFrame:
    """``n`` rows drawn without replacement, the more likely the greater their weight: the least of -log(u) / weight, ``u`` from the seed and the row's key.
    Rows of no weight aren't drawn; rows of one key are drawn together."""
    kept = rows.where(F.col(weight) > 0)
    arrival = -F.log(1 - uniform(seed, *(F.col(k) for k in key))) / F.col(weight)
    return kept.withColumn("arrival_", arrival).orderBy("arrival_", *key).limit(n).drop("arrival_")


def cycled(chunks: DataFrame, key: str, steps: int, seed: int) -> DataFrame:
    """``step`` (from 0) and the chunk's ``key``: chunks without replacement, in a new order each time all have been taken."""
    own = chunks.select(key).distinct()
    n = own.count()
    if not n or steps < 1:
        return own.select(F.lit(0).cast("long").alias("step"), key).limit(0)
    dealt = own.withColumn("round_", F.explode(F.sequence(F.lit(0), F.lit(-(-steps // n) - 1))))
    order = F.row_number().over(Window.partitionBy("round_").orderBy(uniform(seed, F.col("round_"), F.col(key)), key)) - 1
    return dealt.withColumn("step", (F.col("round_") * n + order).cast("long")).where(F.col("step") < steps).select("step", key)


def all_in(volume: DataFrame, label: str, window: tuple[int, int, int], stride: tuple[int, int, int], least: int) -> DataFrame:
    """``z, y, x`` of the starts (multiples of ``stride``) of windows that hold at least ``least`` voxels of a label that isn't 0: each voxel is counted for the
    windows around it, so nothing is read for windows without any."""
    rows = volume.where(F.col(label) != 0).select(*AXES)
    for a, w, s in zip(AXES, window, stride):
        low, high = F.greatest(F.lit(0), F.ceil((F.col(a) - (w - 1)) / s)).cast("int"), F.floor(F.col(a) / s).cast("int")
        rows = rows.where(low <= high).withColumn(a, F.explode(F.sequence(low * s, high * s, F.lit(s))))
    return rows.groupBy(*AXES).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(*AXES)
