"""Near-duplicate groups by a multi-index Hamming join of MinHash signatures.

A document's set of word shingles is hashed to a signature of K symbols of b
bits.  Two sets of Jaccard similarity s differ in a symbol with probability
1 - s, so similar sets have signatures at a small Hamming distance.  The
signature is split into m chunks; by the pigeonhole principle two signatures
at distance <= r = 2m - 1 have a chunk with at most one error.  The allowed
errors are enumerated as deletion variants: a chunk of c symbols gives c keys,
each with one symbol left out, so signatures within r share a key for
certain.  K, m and c are set from the similarity asked for, so that a pair at
the threshold lies beyond r with a probability below ``MISS``.

Every link is then confirmed on the full sets.  Exact copies (equal sets) are
one class first.  Classes that share a key, through any others, form a
cluster; a cluster is cut into blocks of bounded rows and bytes, and each pair
of blocks is one unit of work that reads its texts once, compares signatures,
confirms pairs on the full sets, and returns a spanning forest of its links.
No pair is emitted for a group, no cluster is held whole, none is capped: all
pairs within a cluster whose signatures are within r are confirmed, unless
both ends are already connected.

Scale: keys shuffle 16 bytes a row and pre-aggregate to (lowest, highest)
holder; hot keys are split by the adaptive skew join.  Texts move only for
classes in clusters.

Edge cases: null or empty text, or one without words, has an empty set,
component = its own doc_id, and links with nothing; fewer words than the
shingle width make one shingle; rows with a null doc_id take no part
(component null, kept); rows sharing a doc_id are one document (their links
add up); columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from shelfsync.llm.common import WORD, components, grouped, map_arrow, rows_of, stage

#: Probability that a pair at the threshold lies beyond the signature distance.
MISS = 1e-4
#: A block of a cluster: at most about so many classes and bytes of text.
BLOCK_ROWS, BLOCK_BYTES = 512, 4 << 20
_SYMBOL = np.uint16
_word = re.compile(WORD)
_word_hashes: dict[str, int] = {}


@dataclass(frozen=True)
class Layout:
    """K = chunks * width symbols; distance <= 2 * chunks - 1 is found for certain."""

    chunks: int
    width: int

    @property
    def symbols(self) -> int:
        return self.chunks * self.width

    @property
    def reach(self) -> int:
        return 2 * self.chunks - 1


def layout_for(similarity: float) -> Layout:
    """The widest chunks (most selective keys) that keep a pair at the
    threshold within reach but for ``MISS``."""
    for width in (6, 5, 4, 3):
        for chunks in range(8, 25):
            k, reach = chunks * width, 2 * chunks - 1
            beyond = sum(math.comb(k, i) * (1 - similarity) ** i * similarity ** (k - i) for i in range(reach + 1, k + 1))
            if beyond < MISS and k <= 80:
                return Layout(chunks, width)
    raise ValueError(f"no layout for similarity {similarity}")


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit mixing hash (wraps on purpose)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(words: list[str]) -> np.ndarray:
    import xxhash

    if len(_word_hashes) > 60_000:
        _word_hashes.clear()
    known, digest = _word_hashes, xxhash.xxh64_intdigest
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = digest(w)
        out[i] = h
    return out


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles of ``width`` words."""
    words = _word.findall(text.encode().lower().decode()) if text else []  # bytes: A-Z alone change
    if not words:
        return np.empty(0, np.uint64)
    h = _hash_words(words)
    with np.errstate(over="ignore"):
        if len(h) <= width:
            acc = np.array([len(h)], np.uint64)
            for x in h:
                acc = _mix(acc * np.uint64(3) + x)
        else:
            acc = np.full(len(h) - width + 1, width, np.uint64)
            for k in range(width):
                acc = _mix(acc * np.uint64(3) + h[k:len(h) - width + 1 + k])
    return np.unique(acc)


def _seeds(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return (rng.integers(1, 2**63, k, dtype=np.uint64) | np.uint64(1)), rng.integers(0, 2**63, k, dtype=np.uint64)


def signature(shingles: np.ndarray, k: int) -> np.ndarray:
    """K minima of a set under K hash functions, cut to symbols of 16 bits."""
    a, b = _seeds(k)
    low = np.full(k, np.uint64(2**64 - 1))
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 4096):  # bounded memory for very long texts
            part = shingles[at:at + 4096, None] * a + b
            low = np.minimum(low, (part ^ (part >> np.uint64(29))).min(0))
        return (_mix(low) >> np.uint64(48)).astype(_SYMBOL)


def signatures(docs: DataFrame, width: int, layout: Layout) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, sig``: set size, 128-bit digest of the set, signature."""
    k = layout.symbols

    def run(batches):
        import pyarrow as pa
        import xxhash

        for b in batches:
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = shingle_set(text, width)
                if not len(s):
                    out.append((doc_id, 0, None, None, None))
                    continue
                d = np.frombuffer(xxhash.xxh128_digest(s.tobytes()), np.int64)
                out.append((doc_id, len(s), int(d[0]), int(d[1]), signature(s, k).tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=["doc_id", "n_shingles", "d1", "d2", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").transform(map_arrow, 
        run, "doc_id long, n_shingles long, d1 long, d2 long, sig binary")


def chunk_keys(classes: DataFrame, layout: Layout) -> DataFrame:
    """``key, node``: every deletion variant of every chunk of each class's signature."""
    c, m = layout.width, layout.chunks

    def run(batches):
        import pyarrow as pa

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), _SYMBOL).reshape(n, m, c).astype(np.uint64)
            keys = np.empty((n, m, c), np.uint64)
            chunk = np.arange(m, dtype=np.uint64)
            with np.errstate(over="ignore"):
                for gap in range(c):
                    acc = np.broadcast_to(_mix(chunk * np.uint64(c) + np.uint64(gap + 1)), (n, m))
                    for s in range(c):
                        if s != gap:
                            acc = _mix(acc * np.uint64(3) + sig[:, :, s])
                    keys[:, :, gap] = acc
            node = np.asarray(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(node, m * c))],
                                             names=["key", "node"])

    return classes.select("node", "sig").transform(map_arrow, run, "key long, node long")


def clusters(classes: DataFrame, layout: Layout) -> DataFrame:
    """``node, component`` of the classes that share a key, through any others."""
    keys = chunk_keys(classes, layout)
    met = (keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
           .filter(F.col("hub") < F.col("top")).select("key", "hub"))
    stars = keys.join(met, "key").filter(F.col("node") != F.col("hub"))
    return components(stars.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), "neardup-clusters")


def _confirm(width: int, similarity: int, layout: Layout):
    """Links within each (cluster, block i, block j): a spanning forest of the confirmed pairs."""
    reach, k = layout.reach, layout.symbols

    def linked(x: np.ndarray, y: np.ndarray) -> bool:
        small, large = min(len(x), len(y)), max(len(x), len(y))
        if 100 * small < similarity * large:
            return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= similarity * (len(x) + len(y) - both)

    def run(batches):
        import pyarrow as pa

        links: list[tuple[int, int]] = []
        for (_, i, j), rows in grouped(rows_of(batches), lambda r: r[:3]):
            nodes, blocks, sets = [], [], []
            for _, _, _, block, node, text in rows:  # one pair of blocks: bounded rows and bytes
                nodes.append(node)
                blocks.append(block)
                sets.append(shingle_set(text, width))
            if len(nodes) < 2:
                continue
            sig = np.stack([signature(s, k) for s in sets])
            parent = list(range(len(nodes)))

            def root(x: int, parent: list[int] = parent) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            left = [x for x in range(len(nodes)) if blocks[x] == i]
            right = np.array([x for x in range(len(nodes)) if blocks[x] == j])
            near: list[tuple[int, int, int]] = []
            for x in left:
                others = right[right > x] if i == j else right
                if not len(others):
                    continue
                dist = (sig[others] != sig[x]).sum(1)
                for y in np.flatnonzero(dist <= reach):
                    near.append((int(dist[y]), x, int(others[y])))
            near.sort()  # the likeliest links first: fewer pairs are left to confirm
            for _, x, y in near:
                if (p := root(x)) != (q := root(y)) and linked(sets[x], sets[y]):
                    parent[q] = p
                    links.append((nodes[x], nodes[y]))
            if len(links) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])
                links.clear()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, width: int = 5, similarity: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents with 100 * |A & B| >= similarity * |A | B| over their sets of
    ``width``-word shingles are linked; a component is named by its smallest
    doc_id, which is the one kept.
    """
    layout = layout_for(similarity / 100)
    sigs = stage(signatures(docs, width, layout), "neardup-signatures")
    placed = sigs.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # A class is one distinct set; its node is its smallest doc_id.
    classes = stage(placed.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("top"),
                                                   F.min("sig").alias("sig"), F.count(F.lit(1)).alias("rows")),
                    "neardup-classes")
    group = clusters(classes, layout)
    # Members of clusters meet in blocks; a class is represented by the text of its node's row.
    member = classes.join(group, "node").select("node", "d1", "d2", F.col("component").alias("cluster"))
    reps = placed.select("doc_id", "d1", "d2").distinct() \
        .join(member, "d1 d2".split()).filter(F.col("doc_id") == F.col("node")).select("doc_id", "cluster").distinct()
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(reps, "doc_id")
             .select("cluster", F.col("doc_id").alias("node"), "text"))
    texts = stage(texts, "neardup-members")
    blocks = (texts.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
              .filter(F.col("n") > 1)
              .select("cluster", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES))
                      .cast("int").alias("nb")))
    dealt = texts.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other")
    met = dealt.select("cluster", "block", "node", "text", other)
    met = met.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "node", "text")
    met = met.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    links = met.transform(map_arrow, _confirm(width, similarity, layout), "a long, b long").filter(F.col("a") != F.col("b"))
    # Rows that share a doc_id join the classes they fall in.
    shared = (placed.groupBy("doc_id").agg(F.min("d1").alias("x1"), F.max("d1").alias("x2")).filter("x1 <> x2")
              .select("doc_id").join(placed, "doc_id").join(classes.select("d1", "d2", "node"), ["d1", "d2"])
              .select(F.col("doc_id").alias("a"), F.col("node").alias("b")).filter("a <> b"))
    comp = components(links.union(shared), "neardup-links")
    label = stage(classes.select("d1", "d2", "node").join(comp, "node", "left")
                  .select("d1", "d2", F.coalesce("component", "node").alias("component")), "neardup-labels")
    own = sigs.select("doc_id", "n_shingles", "d1", "d2").join(label, ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return own.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
