"""Substring dedup where rows share a doc_id, or have none."""

import hashlib
import random

import pytest
import xxhash

from shelfsync.llm import prefixfree


def plain(rows):
    """Brute force over (doc_id, text) rows."""
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        if doc is not None:
            for i in range(len(raw) - 49):
                w = raw[i:i + 50]
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        if doc is not None:
            for i in range(len(raw) - 49):
                if first[raw[i:i + 50]] < doc:
                    gone[i:i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def clashing():
    """Two texts whose short keys (24 bits of a 64-bit hash) are equal, found by trying."""
    rnd, seen = random.Random(5), {}
    while True:
        t = "".join(rnd.choice("abcdefgh ") for _ in range(139))
        key = xxhash.xxh64_intdigest(t.encode()) & 0xFFFFFF
        if key in seen:
            return seen[key], t
        seen[key] = t


@pytest.mark.parametrize("broadcast", [True, False])
def test_texts_of_one_id_keep_their_own_cuts(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(prefixfree, "BROADCAST_ROWS", -1)
    a, b = clashing()
    other = "x" + a[:90] + "y" + b[20:100]
    rows = [(1, a), (5, a), (5, b), (5, b), (6, other), (6, a[:60]), (7, None), (7, ""), (7, other), (None, a), (None, a), (None, other),
            (2, "z" * 200), (3, "z" * 60), (3, "z" * 49)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, k1 int, twice int")
    got = prefixfree.digests(prefixfree.remove_repeats(df.repartition(4)))
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
    assert prefixfree.remove_repeats(df.limit(0)).count() == 0
