"""Collocations, hard negatives and decontamination against plain computations."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfsync.llm import collocations, hardneg, winnow

DOCS = "doc_id long, text string, lang string, source string, n long, w1 string, digest string, f string"


def make(spark, rows):
    """(doc_id, text, lang) with columns named like internal ones."""
    return spark.createDataFrame([(*r, "s", 7, "x", "y", "z") for r in rows], DOCS)


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# ------------------------------------------------------------ collocations

def plain_collocations(rows, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in (1, 2, 3):
                for i in range(len(w) - n + 1):
                    counts[lang][tuple(w[i:i + n])] += 1
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= collocations.MIN_COUNT}
        kept = []
        for p, a in cands.items():
            s, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                kept.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def some_docs():
    rnd = random.Random(3)
    vocab = ["ab", "Ba", "c", "dé", "é", "x y", "'s", "zz-z"]
    rows = [(i, "".join(rnd.choice(vocab) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ", " "]) for _ in range(rnd.randint(0, 60))),
             rnd.choice(["en", "en", "fr", None, "und"])) for i in range(120)]
    rows += [(i, "the same line of common words!", "en") for i in range(500, 560)]  # one very frequent line
    return rows + [(7, None, "en"), (8, "", None), (8, "", None), (9, " . ,, \t", "fr"), (None, "ab c ab c " * 4, "fr"),
                   (10, "c dé " * 9000, "de")]


@pytest.mark.parametrize("step", [None, 64])
def test_collocations(spark, monkeypatch, step):
    if step:  # many steps, and texts cut into slices; a small table of bits, so that many pairs clash
        monkeypatch.setattr(collocations, "STEP", step)
        monkeypatch.setattr(collocations, "SLICE", 50)
        monkeypatch.setattr(collocations, "FILTER_BITS", 6)
    rows = some_docs()
    for top in (2000, 3):
        got = sorted(map(tuple, collocations.collocations(make(spark, rows).repartition(3), top)
                         .select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))
        assert got == plain_collocations(rows, top)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(make(spark, [])).count() == 0
    assert collocations.collocations(make(spark, [(1, None, None), (2, " ", "en")])).count() == 0


def test_collocation_scores_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_007, 4_000_000_000_001, 5_000_000_000_003
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    got = df.select(collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()["s"]
    assert got == 1000000 * a * a // (l * r)


# ------------------------------------------------------------ hard negatives

def plain_negatives(rows, is_anchor):
    fine = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if all(abs(x) <= hardneg.LARGEST for x in q):
            fine.append((vec_id, q, label))
    out, done = [], set()
    for vec_id, q, label in fine:
        if not is_anchor(vec_id) or (vec_id, tuple(q), label) in done:
            continue
        done.add((vec_id, tuple(q), label))
        scored = sorted((-sum(x * y for x, y in zip(q, p, strict=True)), i, other) for i, p, other in fine
                        if i != vec_id and len(p) == len(q))
        for ps, pid in [(s, i) for s, i, o in scored if o == label][:5]:
            near = [(s, i) for s, i, o in scored if o != label and 30 * -ps <= 100 * -s <= 90 * -ps][:10]
            out += [(vec_id, pid, r + 1, nid, -ps, -s) for r, (s, nid) in enumerate(near)]
    return sorted(out)


def some_vectors(n, dim, labels, seed, spread=1.0):
    rnd = random.Random(seed)
    centre = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    return [(i, [centre[i % labels][d] + rnd.gauss(0, spread) for d in range(dim)], (i * 7 // 3) % labels) for i in range(n)]


@pytest.mark.parametrize("dim,spread,blocks", [(3, 0.3, 8), (16, 1.0, 16)])
def test_hard_negatives(spark, monkeypatch, dim, spread, blocks):
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(hardneg, "PIECE", 4)
    monkeypatch.setattr(hardneg, "ZONES", 16)
    monkeypatch.setattr(hardneg, "ANCHORS", 6)
    rows = some_vectors(400, dim, 4, 5, spread)
    same = [0.5] * dim
    rows += [(1000 + i, same, 1) for i in range(60)] + [(2000 + i, same, 2) for i in range(60)]  # ties
    rows += [(20, same, 1)] * 3 + [(20, rows[20][1], rows[20][2])]  # repeated ids and rows
    rows += [(None, same, 1), (3000, None, 1), (3010, same, None), (3020, [math.nan] * dim, 1), (3030, [math.inf] + same[1:], 1),
             (3040, [None] + same[1:], 1), (3050, [1e30] + same[1:], 1), (3060, [1.0, 2.0, 3.0, 4.0], 1), (3070, [1.0, 1.0, 1.0, 1.0], 2),
             (3080, [1.0, 1.0, 1.0, 2.0], 1), (3090, [], 1), (3100, [], 2), (3110, [-9.0] * dim, 9), (3120, [9.0] * dim, 9)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, block int, part string")
    out = hardneg.hard_negatives(df, F.col("vec_id") % 10 == 0)
    got = sorted(map(tuple, out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))
    assert got == plain_negatives(rows, lambda i: i % 10 == 0)
    assert hardneg.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_hilbert_curve_steps_to_neighbours():
    import numpy as np

    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = hardneg.hilbert(cells, 3)
    assert sorted(key) == list(range(512))
    along = cells[np.argsort(key)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_blocks_are_skipped(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x, q = rng.integers(-300, 300, (50, 5)), rng.integers(-300, 300, (7, 5))
    least, most = hardneg.bounds(q, x.min(0)[None], x.max(0)[None])
    s = q @ x.T
    assert (least[:, 0] <= s.min(1)).all() and (most[:, 0] >= s.max(1)).all()
    # Few dimensions: most blocks lie outside an anchor's windows and are not asked for.
    rows = some_vectors(4000, 2, 4, 9, 0.2)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    old = hardneg.BLOCK_ROWS
    try:
        hardneg.BLOCK_ROWS = 32
        valid = hardneg.valid(df, F.col("vec_id") % 100 == 0)
        keyed = hardneg.map_arrow(valid, hardneg._keyed(hardneg.curve_layout(valid)),
                                  "vec_id long, label long, dim int, anchor boolean, key long, q binary")
        blocks = hardneg.stage(hardneg.blocks_of(keyed), "test-blocks").toArrow()
    finally:
        hardneg.BLOCK_ROWS = old
    zones = {c: np.frombuffer(b"".join(blocks.column(c).to_pylist()), np.int64).reshape(blocks.num_rows, 2) for c in ("lo", "hi")}

    class Win:
        q = np.array([[300, 100]])
        of, label, low, high = np.array([0]), np.array([1]), np.array([-hardneg._FAR]), np.array([hardneg._FAR])

    need = hardneg.wanted(Win, blocks.column("label").to_numpy(), blocks.column("n").to_numpy(), zones["lo"], zones["hi"], 5, True)
    assert 0 < need.sum() < blocks.num_rows / 8


# ------------------------------------------------------------ decontamination

def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))


def plain_decontaminate(docs, bench):
    items = defaultdict(set)
    for item, text in bench:
        w = plain_words(text)
        if item is not None and w:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                items[tuple(w[i:i + n])].add(str(item))
    out = []
    for doc_id, text, _ in docs:
        w, hit, found = plain_words(text), set(), set()
        for win, ids in items.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def planted(seed=4):
    rnd = random.Random(seed)
    vocab = ["a", "B", "c3", "dé", "É", "ı", "İx", "the"]

    def text(n):
        return "".join(rnd.choice(vocab) + rnd.choice([" ", "-", "\n", ". "]) for _ in range(n))

    bench = [(i, text(rnd.randint(10, 30))) for i in range(12)] + [(50, text(9)), (51, "one"), (52, "Two three"), (53, None),
                                                                   (54, " -- "), (None, text(12)), (55, "a " * 30), (0, text(15))]
    docs = [(i, text(rnd.randint(0, 80)), "en") for i in range(60)]
    for i in range(30):
        w = bench[i % 12][1]
        docs.append((100 + i, text(rnd.randint(0, 9)) + w[rnd.randint(0, 12):len(w) - rnd.randint(0, 12)].upper() + text(3), "en"))
    common = "x y " + bench[3][1] + " z"
    docs += [(200 + i, common, None) for i in range(300)]  # one text that many documents share
    docs += [(5, None, None), (5, "", "x"), (5, "one two", "x"), (5, "one two", "x"), (None, "two, THREE", None), (6, "a " * 20000, "en")]
    return docs, bench


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(winnow, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(winnow, "BROADCAST_BYTES", -1)
    docs, bench = planted()
    b = spark.createDataFrame([(*r, "x") for r in bench], "item_id long, text string, digest string")
    out = winnow.decontaminate(make(spark, docs), b)
    got = sorted(map(tuple, out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)
    assert got == plain_decontaminate(docs, bench)


def test_decontamination_of_nothing(spark):
    b = spark.createDataFrame([], "item_id long, text string")
    assert winnow.decontaminate(make(spark, []), b).count() == 0
    rows = winnow.decontaminate(make(spark, [(1, "a b", "en")]), b).collect()
    assert [(r["doc_id"], r["n_words"], r["n_hit"], r["contaminated"]) for r in rows] == [(1, 2, 0, False)]


def test_decontamination_is_native(spark):
    docs, bench = planted()
    out = winnow.decontaminate(make(spark, docs), spark.createDataFrame(bench, "item_id long, text string"))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
