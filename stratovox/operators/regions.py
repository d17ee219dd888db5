"""Region graphs: touching regions with composable edge statistics, scores and merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratovox.operators.components import components
from stratovox.operators.stencils import before
from stratovox.sources.volumes import AXES


def faces(volume: DataFrame, label: str, affinities: dict[str, str]) -> DataFrame:
    """``u, v, aff``: a row for each face between two voxels of different regions (u < v, neither 0); ``affinities``: a column for each axis."""
    parts = [F.struct(before(label, a).alias("o"), F.col(affinities[a]).alias("aff")) for a in AXES]
    rows = volume.select(F.col(label).alias("p"), F.array(*parts).alias("n")).select("p", F.explode("n").alias("n"))
    rows = rows.where((F.col("p") != 0) & (F.col("n.o") != 0) & (F.col("p") != F.col("n.o")))
    return rows.select(F.least("p", "n.o").alias("u"), F.greatest("p", "n.o").alias("v"), F.col("n.aff").alias("aff"))


#: Aggregates of an edge's affinities by name.
STATISTICS = {
    "max": lambda: F.max("aff"), "min": lambda: F.min("aff"), "mean": lambda: F.avg("aff"), "contact": lambda: F.count("*"),
}


def graph(touching: DataFrame, *statistics: str) -> DataFrame:
    """One row for each pair of touching regions with the named statistics, each computed once."""
    return touching.groupBy("u", "v").agg(*(STATISTICS[s]().alias(s) for s in statistics))


def mean_of_greatest(touching: DataFrame, k: int) -> DataFrame:
    """Mean of the ``k`` greatest affinities of each edge; ranks are taken per edge, so nothing is collected."""
    rank = F.row_number().over(Window.partitionBy("u", "v").orderBy(F.desc("aff")))
    return touching.withColumn("r", rank).where(F.col("r") <= k).groupBy("u", "v").agg(F.avg("aff").alias("mean_max"))


def histogram_quantile(rows: DataFrame, keys: list[str], value: str, quantile: int, bins: int) -> DataFrame:
    """Centre of the first bin at which the running count exceeds the quantile; a histogram is the pre-aggregated form, so keys of any size are cheap."""
    bin_of = F.least(F.floor(F.col(value) * bins), F.lit(bins - 1)).cast("int")
    counts = rows.groupBy(*keys, bin_of.alias("bin")).agg(F.count("*").alias("n"))
    by = Window.partitionBy(*keys)
    running = counts.withColumn("seen", F.sum("n").over(by.orderBy("bin"))).withColumn("total", F.sum("n").over(by))
    reached = running.where(F.col("seen") >= F.expr(f"({quantile} * total) div 100 + 1"))
    lowest = reached.groupBy(*keys).agg(F.min("bin").alias("bin"))
    return lowest.select(*keys, ((F.col("bin") + 0.5) / F.lit(float(bins))).alias("quantile"))


def region_sizes(volume: DataFrame, label: str) -> DataFrame:
    return volume.where(F.col(label) != 0).groupBy(F.col(label).alias("id")).agg(F.count("*").alias("size"))


def with_sizes(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Edges with the smaller and the larger size of their two regions."""
    u, v = (sizes.select(F.col("id").alias(c), F.col("size").alias(f"size_{c}")) for c in "uv")
    joined = edges.join(u, "u").join(v, "v")
    return joined.select(*edges.columns, F.least("size_u", "size_v").alias("min_size"), F.greatest("size_u", "size_v").alias("max_size"))


_HUGE = 1.7976931348623157e308


def divided(a: Column, b: Column) -> Column:
    """a / b; where b is at most 1e-300 the greatest double with the sign of a."""
    return F.when(F.abs(b) > 1e-300, a / b).when(a >= 0, F.lit(_HUGE)).otherwise(F.lit(-_HUGE))


def inverted(a: Column) -> Column:
    return divided(F.lit(1.0), a)


def stepped(a: Column, b: Column) -> Column:
    """0 below ``b``, 1 from there on. Other scores are plain arithmetic on the columns of statistics."""
    return F.when(a < b, F.lit(0.0)).otherwise(F.lit(1.0))


def random_score(seed: int) -> Column:
    """The same number from 0 to 1 for the same edge and seed, whatever the order of rows."""
    return F.pmod(F.xxhash64("u", "v", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def merged_below(edges: DataFrame, score_column: str, threshold: float) -> DataFrame:
    """``(id, rep)``: regions joined over all edges that score below ``threshold``, named by the least id.

    For scores that merging can't raise (one minus the greatest affinity) this is what merging the cheapest edge
    again and again comes to, and it needs no order.
    """
    found = components(edges.where(F.col(score_column) < threshold), "u", "v")
    found = found.union(found.select(F.col("root"), "root").distinct())
    return found.select(F.col("node").alias("id"), F.col("root").alias("rep"))
