"""All registered queries of the volume operators, with the SQL that checks them."""

from __future__ import annotations

from stratovox.plans import crops, decoders, holes, instances, labels, losses, metrics, more, overlap, regions, sampling, segmentation, stateful, targets, warps  # noqa: F401  (each module registers its queries)
from stratovox.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
