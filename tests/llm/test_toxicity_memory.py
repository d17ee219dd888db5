"""The fit on the driver holds its kernel table and little besides."""

from __future__ import annotations

import random
import tracemalloc

from stratovox.llm.toxicity import nystroem_machine


def test_the_fit_holds_few_copies_of_its_kernels():
    r = random.Random(1)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 5))) for _ in range(20_000)]
    tracemalloc.start()
    try:
        machine = nystroem_machine(words[:300], words[300:])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(machine.numbers) and peak < 3 * 300 * len(words) * 8
