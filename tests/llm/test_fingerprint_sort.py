"""Fingerprints of repeated names, and that these are found by sorting."""

import numpy as np

from riskwatch.llm import fingerprint as FP


def test_names_are_distinct_and_ascending(monkeypatch):
    """np.unique goes through a hash table, which took two thirds of the time."""
    monkeypatch.setattr(np, "unique", None)
    texts = [b"", b"ab" * 500, b"a", bytes(range(256)) * 30, b"the same words, " * 200]
    found = FP.sketches(texts)
    assert [len(x) for x in found][:1] == [0] and all(1 <= len(x) <= FP.SKETCH for x in found[1:])
    assert all((x[1:] > x[:-1]).all() for x in found)
    assert all((x == FP.sketches([t])[0]).all() for x, t in zip(found, texts, strict=True))
