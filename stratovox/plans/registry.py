"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}

#: The voxel view in DuckDB's SQL, equal to :func:`stratovox.sources.volumes.voxels`.
VOXELS = """
with recursive voxels as (
  select cast(event_id // 500 as integer) as z, cast((event_id // 25) % 20 as integer) as y, cast(event_id % 25 as integer) as x,
         user_id as seg, 1 + ((event_id // 500) // 4) * 4 + (((event_id // 25) % 20) // 10) * 2 + (event_id % 25) // 13 as gt,
         least(cast(value as double) / cast(100 as double), cast(1 as double)) as img, event_type <> 'error' as msk
  from events)
"""


def query(name: str, sql: str | None = None, voxels: bool = True):
    """Register a query of (spark, sf_dir); its SQL may use the view ``voxels``, and starts with ``,`` or ``select``."""

    def put(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = (VOXELS if voxels else "") + sql
        return f

    return put


def components_sql(table: str, e: str = "e", reach: str = "reach") -> str:
    """SQL of face-connected components of ``table`` (z, y, x, a label ``l`` and an index ``i``): ``reach(i, low)`` with each voxel's least index, by
    passing smaller indices on until nothing changes."""
    same = {"z": "b.z = a.z + 1 and b.y = a.y and b.x = a.x", "y": "b.z = a.z and b.y = a.y + 1 and b.x = a.x", "x": "b.z = a.z and b.y = a.y and b.x = a.x + 1"}
    pairs = " union all ".join(f"select a.i as i, b.i as j from {table} a join {table} b on b.l = a.l and {near}" for near in same.values())
    return f""", {e}_ as ({pairs}), {e} as (select i, j from {e}_ union all select j, i from {e}_),
    {reach}(i, low) using key (i) as (select i, i from {table} union (select n.j, min(r.low) from {reach} r join {e} n on n.i = r.i join recurring.{reach} o on o.i = n.j where r.low < o.low group by n.j))"""
