"""Substring dedup by prefix-free parsing.

Removes every byte covered by a ``LENGTH``-byte string that also starts in a
document with a smaller doc_id, exactly, on UTF-8 bytes.

Rolling hashes of ``GRAM`` bytes trigger phrases: each window of LENGTH bytes
is assigned to the smallest gram hash inside it, and a phrase is the text of a
run of windows with one trigger.  Triggers depend on content alone, so equal
strings are cut into equal phrases wherever they occur; every window lies
inside one phrase.  The dictionary is the set of distinct phrases, the parse
is each document's sequence of them.

1. Parse: (trigger, phrase digest, document, place) per phrase, sorted by
   trigger and digest: the order of the corpus' phrases.  A phrase met before
   in an earlier document is removed whole.  Repetitive text ends here.
2. Dictionary: a trigger with several phrases (the edges of repeated
   passages) compares them window by window: a table of their LENGTH-byte
   windows tells which occur in an earlier document.
3. Texts: the removed intervals come back to their document and are merged.

No suffix arrays of dictionary and parse are built: repeats have one fixed
length, and every window of that length lies inside one phrase, so grouping
by trigger and comparing windows decides each without an order of suffixes.
The parse's order is needed only as each phrase's place.

Scale: one row of four numbers per about 18 bytes of text is shuffled, then
only repeated phrases; texts travel compressed, and only to join their own
verdicts.  Groups stream in sorted order: a trigger's state holds only the
first document of each distinct phrase, so a passage in a third of the
documents streams through.

Edge cases: null text is empty; texts shorter than LENGTH lose nothing; rows
with a null doc_id are kept whole and remove nothing; rows that share a doc_id
are the same document and do not remove from each other, each row keeps its
own text (their texts are told apart by 128-bit digests); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from shelfsync.llm.common import grouped, map_arrow, rows_of, stage

LENGTH, GRAM = 50, 16
_GRAMS = LENGTH - GRAM + 1
#: Windows handled at a time; a place inside fits the low bits of a hash.
_PIECE = 1 << 19
_LOW = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_RUN_BITS = 6
#: Rows of doc_ids that several rows share, which may be broadcast at most.
BROADCAST_ROWS = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = np.uint64(base)
        return np.cumprod(out, dtype=np.uint64)


_POWER = _powers(_BASE, _PIECE + LENGTH)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), _PIECE + LENGTH)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def phrases(values: np.ndarray, offsets: np.ndarray):
    """(trigger, digest, document index, start, windows) arrays of the phrases of
    texts laid end to end in ``values`` at ``offsets``, piece by piece."""
    n = len(values)
    inside = np.zeros(n + 1, np.int8)  # window starts that stay inside their document
    starts, ends = offsets[:-1], offsets[1:] - LENGTH + 1
    long_enough = ends > starts
    np.add.at(inside, starts[long_enough], 1)
    np.add.at(inside, ends[long_enough], -1)
    inside = np.cumsum(inside, dtype=np.int8).astype(bool)
    for at in range(0, n - LENGTH + 1, _PIECE):
        stop = min(at + _PIECE, n - LENGTH + 1)
        ok = inside[at:stop]
        if not ok.any():
            continue
        seg = np.ascontiguousarray(values[at:stop + LENGTH - 1])
        with np.errstate(over="ignore"):
            eight = np.ndarray(len(seg) - 7, "<u8", buffer=seg, strides=(1,))
            eight = _mixed(eight.astype(np.uint64))
            gram = eight[:-8] * np.uint64(3) + (eight[8:] ^ (eight[8:] >> np.uint64(31)))
            gram = _mixed(gram)
            low = (gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64)
            width = 1
            while 2 * width <= _GRAMS:
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            k = stop - at
            trigger = (np.minimum(low[:k], low[_GRAMS - width:_GRAMS - width + k]) & _LOW).astype(np.int64)
            new = np.ones(k, bool)
            new[1:] = (trigger[1:] != trigger[:-1]) | ~ok[:-1]
            first = np.flatnonzero(new & ok)
            last = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))
            sums = np.zeros(len(eight) + 1, np.uint64)
            np.cumsum(eight * _POWER[:len(eight)], out=sums[1:])
            runs = (last - first + 1).astype(np.uint64)
            digest = (sums[last + LENGTH - 7] - sums[first]) * _INVERSE[first]
            digest = _mixed(digest + runs * np.uint64(0x9E3779B97F4A7C15) + (trigger[first] - first).astype(np.uint64))
        doc = np.searchsorted(offsets, at + first, "right") - 1
        yield gram[trigger[first]], digest, doc, at + first - offsets[doc], runs.astype(np.int64)


def _text_keys(texts: list[bytes], shared: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """The 128-bit digests of texts whose doc_id other rows share, in two
    halves; 0 for the rest, which their doc_id tells apart."""
    import xxhash

    out = np.zeros((len(texts), 2), np.int64)
    for i, (t, s) in enumerate(zip(texts, shared, strict=True)):
        if s:
            out[i] = np.frombuffer(xxhash.xxh128_digest(t), np.int64)
    return out[:, 0], out[:, 1]


def _with_shared(docs: DataFrame) -> DataFrame:
    """``doc, text, shared``: whether several rows have the doc_id (or it is null)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    several = stage(rows.filter(F.col("doc").isNotNull()).groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
                    .filter(F.col("n") > 1).select(F.col("doc").alias("twice")), "phrase-shared")
    if several.count() <= BROADCAST_ROWS:
        several = F.broadcast(several)
    return (rows.join(several, F.col("doc") == F.col("twice"), "left")
            .select("doc", "text", (F.col("doc").isNull() | F.col("twice").isNotNull()).alias("shared")))


def parse(docs: DataFrame) -> DataFrame:
    """``h, p, doc, at, k1, k2``: trigger, phrase digest, document, packed place
    (start, windows) and text key of each phrase of ``doc, text, shared`` rows."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            text = b.column(1).cast(pa.large_binary())
            raw = text.fill_null(b"")
            offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
            values = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] is not None else np.empty(0, np.uint8)
            values, offsets = values[offsets[0]:offsets[-1]], offsets - offsets[0]
            k1, k2 = _text_keys(raw.to_pylist(), b.column(2).to_pylist())
            ids = b.column(0).to_numpy()
            for h, p, doc, start, runs in phrases(values, offsets):
                at = (start << _RUN_BITS) | runs
                for lo in range(0, len(h), 65536):  # small batches on the way out
                    s = slice(lo, lo + 65536)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[s].view(np.int64)), pa.array(p[s].view(np.int64)), pa.array(ids[doc[s]]), pa.array(at[s]),
                         pa.array(k1[doc[s]]), pa.array(k2[doc[s]])], names=["h", "p", "doc", "at", "k1", "k2"])

    return docs.filter(F.col("doc").isNotNull()).transform(map_arrow, run, "h long, p long, doc long, at long, k1 long, k2 long")


def _verdicts(batches):
    """From phrases sorted by (h, p, doc, at): those met in an earlier document
    (whole = true), and the first of each phrase of a trigger whose phrases
    differ and begin in several documents (whole = false)."""
    import pyarrow as pa

    names = ["doc", "at", "h", "k1", "k2", "whole"]
    held = [np.empty(0, np.int64)] * 6

    def table(rows, whole: bool):
        h, _, doc, at, k1, k2 = rows
        return pa.RecordBatch.from_arrays([*map(pa.array, (doc, at, h, k1, k2)), pa.array(np.full(len(h), whole))], names=names)

    def differing(rows):
        """Rows of triggers with several phrases that do not all begin in one document."""
        h, p, doc = rows[:3]
        if not len(h):
            return np.empty(0, bool)
        new = np.append(True, h[1:] != h[:-1])
        group = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        lo, hi = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
        several = np.maximum.reduceat(p, at) != np.minimum.reduceat(p, at)
        return (several & (lo < hi))[group]

    for b in batches:
        if not b.num_rows:
            continue
        rows = [np.concatenate([o, c.to_numpy()]) for o, c in zip(held, b.columns, strict=True)]
        h, p, doc = rows[:3]
        new = np.append(True, (h[1:] != h[:-1]) | (p[1:] != p[:-1]))
        first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        again = doc > first
        if again.any():
            yield table([x[again] for x in rows], True)
        rows = [x[~again] for x in rows]
        done = rows[0] != rows[0][-1]
        held = [x[~done] for x in rows]
        rows = [x[done] for x in rows]
        open_ = differing(rows)
        if open_.any():
            yield table([x[open_] for x in rows], False)
    open_ = differing(held)
    if open_.any():
        yield table([x[open_] for x in held], False)


def _packed(docs: DataFrame) -> DataFrame:
    """``doc, k1, k2, kind = 0, at = 0, z``: texts compressed for the shuffle."""

    def run(batches):
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                raw = [(t.as_py() or "").encode() for t in part.column(1)]
                n = len(raw)
                k1, k2 = _text_keys(raw, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(k1), pa.array(k2), pa.array([0] * n, pa.int64()),
                     pa.array([0] * n, pa.int64()), pa.array([press.compress(r) for r in raw], pa.binary())],
                    names=["doc", "k1", "k2", "kind", "at", "z"])

    return docs.transform(map_arrow, run, "doc long, k1 long, k2 long, kind long, at long, z binary")


def _beside(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """Texts, each followed by its marks (``doc, k1, k2, at, to`` sorted by at); rows of one document meet in one task."""
    both = texts.withColumn("to", F.lit(0).cast("long")).unionByName(
        marks.select("doc", "k1", "k2", F.lit(1).cast("long").alias("kind"), "at", F.lit(None).cast("binary").alias("z"), "to"))
    # Null ids have no marks; they are dealt by their text.
    return (both.select("doc", "k1", "k2", "kind", "at", "to", "z").repartition("doc", "k1", "k2")
            .sortWithinPartitions("doc", "k1", "k2", "kind", "at"))


def _edge_texts(batches):
    """(h, doc, at, k1, k2, text of the phrase) of the phrases to compare window by window."""
    import pyarrow as pa
    import zstandard

    open_ = zstandard.ZstdDecompressor()
    out: list[tuple] = []
    names = ["h", "doc", "at", "k1", "k2", "phrase"]
    for (doc, k1, k2), rows in grouped(rows_of(batches), lambda r: r[:3]):
        raw = z = None
        for _, _, _, kind, at, h, text in rows:
            if kind == 0:
                z = text
                continue
            if raw is None:
                raw = open_.decompress(z, max_output_size=1 << 31)
            start, runs = at >> _RUN_BITS, at & ((1 << _RUN_BITS) - 1)
            out.append((h, doc, at, k1, k2, raw[start:start + runs + LENGTH - 1]))
        if len(out) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)


def _compare(batches):
    """Windows of differing phrases of one trigger that start in an earlier document."""
    import pyarrow as pa

    out: list[tuple] = []
    names = ["doc", "k1", "k2", "at", "to"]
    for _, rows in grouped(rows_of(batches), lambda r: r[0]):
        first: dict[bytes, int] = {}
        for _, doc, at, k1, k2, phrase in rows:  # in order of doc
            start = at >> _RUN_BITS
            open_at = -1
            for i in range(len(phrase) - LENGTH + 2):
                window = phrase[i:i + LENGTH] if i <= len(phrase) - LENGTH else None
                met = window is not None and first.setdefault(window, doc) < doc
                if met and open_at < 0:
                    open_at = i
                elif not met and open_at >= 0:
                    out.append((doc, k1, k2, start + open_at, start + i - 1 + LENGTH))
                    open_at = -1
        if len(out) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)


def _cut(batches):
    """Each text less the union of its marked intervals."""
    import pyarrow as pa
    import zstandard

    open_ = zstandard.ZstdDecompressor()
    kind_of_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    out: list[tuple] = []
    held = 0

    def made():
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.binary()), pa.array(cols[3], kind_of_span)],
                                          names=["doc_id", "n_bytes", "kept", "spans"])

    for (doc, *_), rows in grouped(rows_of(batches), lambda r: r[:3]):
        texts: list[bytes] = []
        spans: list[list[int]] = []
        for _, _, _, kind, at, to, z in rows:
            if kind == 0:
                texts.append(z)
            elif spans and at <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], to)
            else:
                spans.append([at, to])
        for z in texts:
            raw = open_.decompress(z, max_output_size=1 << 31)
            kept, pos = [], 0
            for a, b in spans:
                kept.append(raw[pos:a])
                pos = b
            kept.append(raw[pos:])
            out.append((doc, len(raw), b"".join(kept), [{"start": a, "end": b} for a, b in spans]))
            held += len(raw)
            if held >= 8 << 20 or len(out) >= 4096:
                yield made()
                out, held = [], 0
    if out:
        yield made()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, kept, spans`` for each row of ``docs``: the remaining
    bytes and the maximal removed intervals (byte offsets)."""
    docs = _with_shared(docs)
    order = ["h", "p", "doc", "at", "k1", "k2"]
    found = stage(parse(docs).repartition("h").sortWithinPartitions(*order)
                  .transform(map_arrow, _verdicts, "doc long, at long, h long, k1 long, k2 long, whole boolean"), "phrase-verdicts")
    edge = found.filter(~F.col("whole")).select("doc", "k1", "k2", "at", F.col("h").alias("to"))
    edges = _beside(_packed(docs), edge).transform(map_arrow, _edge_texts, "h long, doc long, at long, k1 long, k2 long, phrase binary")
    met = stage(edges.repartition("h").sortWithinPartitions("h", "doc", "at", "k1", "k2")
                .transform(map_arrow, _compare, "doc long, k1 long, k2 long, at long, to long"), "phrase-edges")
    start = F.shiftright(F.col("at"), _RUN_BITS)
    runs = F.col("at").bitwiseAND(F.lit((1 << _RUN_BITS) - 1))
    whole = found.filter("whole").select("doc", "k1", "k2", start.alias("at"), (start + runs + F.lit(LENGTH - 1)).alias("to"))
    return _beside(_packed(docs), whole.unionByName(met)).transform(
        map_arrow, _cut, "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")


def digests(removed: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of :func:`remove_repeats`."""
    return removed.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                          F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
