"""Distances along lines of many stretches."""

from __future__ import annotations

import numpy as np

from stratovox.operators import distances


def test_cells_of_a_line_grow_with_its_voxels(monkeypatch):
    """Many stretches of one long line: a row of the whole line's length for each made the pass quadratic."""
    seen = []
    plain = distances.lower_envelope
    monkeypatch.setattr(distances, "lower_envelope", lambda f, step: seen.append(f.size) or plain(f, step))
    label = np.repeat(np.arange(900) % 3, 2)[None]
    distances.along_lines(label, np.full(label.shape, np.inf), 1.0)
    assert sum(seen) <= 4 * label.size
