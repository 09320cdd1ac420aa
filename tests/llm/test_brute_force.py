"""Each operator against a plain computation, on small tables of its own or sf0.001."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsync.llm import ann, bm25, chat, linechunks, mixing, neardup, pagetext, prefixfree, queries, spm, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


DOCS = "doc_id long, text string, lang string, source string, n_chars long, SIZE string, H string, score double"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty and long texts, repeats and columns named like internal ones."""
    def make(texts, sources=None):
        rows = [(i, t, "en", (sources or {}).get(i, "s"), len(t or ""), "x", "y", 1.0) for i, t in
                (texts.items() if isinstance(texts, dict) else texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def invented(n, seed=1, near=0):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("aeioubcdr") for _ in range(rnd.randint(2, 6))) for _ in range(400)]
    texts = {}
    for i in range(n):
        if near and i % 3 and i > 3:
            w = texts[rnd.randrange(max(0, i - 6), i)].split(" ")
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
        else:
            w = [rnd.choice(vocab) for _ in range(rnd.randint(1, 90))]
        texts[i] = " ".join(w)
    return texts


def test_sql_oracles(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in queries.ORACLE.items():
        a = queries.QUERIES[name](spark, SF).toPandas()
        b = con.sql(sql).df()
        cols = sorted(b.columns)
        assert sorted(a.columns) == cols
        a, b = (x[cols].sort_values([c for c in ("doc_id", "lang", "rank", "anchor_id", "positive_id") if c in cols])
                .reset_index(drop=True) for x in (a, b))
        assert len(a) and a.equals(b), name


def shingles(t, k):
    w = words(t)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


@pytest.mark.parametrize("width,similarity", [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, width, similarity, monkeypatch):
    texts = {**invented(150, near=1), 200: None, 201: "", 202: "a b", 203: "A  b", 204: " \t ", 205: "a b"}
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 20)  # clusters over several blocks
    sets = {i: shingles(t, width) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in texts:
        for j in texts:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    rows = {r["doc_id"]: r for r in neardup.near_duplicates(docs(texts), width, similarity).collect()}
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in rows.items()} == \
        {i: (len(sets[i]), root(i), root(i) == i) for i in texts}


def test_near_duplicates_null_ids_and_repeated_rows(spark, docs):
    t = "one two three four five six seven"
    out = neardup.near_duplicates(docs([(1, t), (1, t), (None, t), (3, t)]), 3, 85).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"], r["component_id"], r["kept"]) for r in out), key=str) == sorted(
        [(False, 1, 1, True), (False, 1, 1, True), (False, 3, 1, False), (True, None, None, True)], key=str)


def brute_spans(texts):
    first, out = {}, {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        cover = bytearray(len(raw))
        w = [raw[k:k + 50] for k in range(len(raw) - 49)]
        for k, s in enumerate(w):
            if first.get(s, i) < i:
                cover[k:k + 50] = b"\1" * 50
        for s in w:
            first.setdefault(s, i)
        spans = sum(1 for k in range(len(raw)) if cover[k] and (not k or not cover[k - 1]))
        out[i] = (len(raw), sum(cover), spans, hashlib.sha256(bytes(b for b, c in zip(raw, cover) if not c)).hexdigest())
    return out


def test_substring_dedup(spark, docs):
    rnd = random.Random(3)
    base = invented(12, 5)
    pool = " ".join(base.values())
    texts = {}
    for i in range(120):
        parts = [rnd.choice(["é", "x", "ß "]) * rnd.randint(0, 70), "ab" * rnd.randint(0, 60)]
        for _ in range(rnd.randint(0, 4)):
            a = rnd.randrange(len(pool))
            parts.append(pool[a:a + rnd.randint(20, 200)])
        rnd.shuffle(parts)
        texts[i] = "".join(parts)
    texts |= {500: None, 501: "", 502: texts[3], 503: "z" * 3000, 504: "z" * 49, 505: "z" * 50}
    got = prefixfree.digests(prefixfree.remove_repeats(docs(texts))).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute_spans(texts)


def test_substring_dedup_in_pieces(monkeypatch):
    """Phrases cut by piece borders still hold every window once."""
    monkeypatch.setattr(prefixfree, "_PIECE", 64)
    raw = "".join(invented(3).values()).encode()
    offsets = np.array([0, 30, 30, 200, len(raw)])
    n = 0
    for _, _, doc, start, runs in prefixfree.phrases(np.frombuffer(raw, np.uint8), offsets):
        assert (start >= 0).all() and (start + runs + 49 <= (offsets[1:] - offsets[:-1])[doc]).all()
        n += runs.sum()
    assert n == (170 - 49) + (len(raw) - 200 - 49)


def test_bm25(spark, docs):
    texts = {**invented(300, 7), 900: None, 901: "", 902: invented(300, 7)[0]}
    got = bm25.top_k(docs(texts), F.col("doc_id") % 50 == 0, 10).collect()
    bags = {i: words(t) for i, t in texts.items()}
    n, avg = len(texts), sum(map(len, bags.values())) / len(texts)
    df = {}
    for b in bags.values():
        for w in set(b):
            df[w] = df.get(w, 0) + 1
    for q in (i for i in texts if i % 50 == 0):
        score = {}
        for d, b in bags.items():
            s = sum(np.log(1 + (n - df[w] + .5) / (df[w] + .5)) * b.count(w) * 2.2 / (b.count(w) + 1.2 * (.25 + .75 * len(b) / avg))
                    for w in set(bags[q]) & set(b))
            if s:
                score[d] = s
        want = sorted(score.items(), key=lambda x: (-round(x[1], 9), x[0]))[:10]
        have = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [x[1] for x in have] == [d for d, _ in want]
        assert np.allclose([x[2] for x in have], [s for _, s in want])


def test_bm25_moves_no_text_for_chunks_of_queries(spark, docs, monkeypatch):
    """Documents are neither shuffled nor copied for any number of chunks and shards, and results stay as they are."""
    df = docs([*invented(200, 9).items(), (0, "again"), (7, None), (7, "again"), (None, "again")])
    asked = F.col("doc_id") % 10 == 0
    want = sorted(map(tuple, bm25.top_k(df, asked, 5).collect()))
    plans, write = [], bm25.stage
    monkeypatch.setattr(bm25, "stage", lambda x, name: plans.append((name, x._jdf.queryExecution().executedPlan().toString())) or write(x, name))
    monkeypatch.setattr(bm25, "CHUNK_ROWS", 8)
    monkeypatch.setattr(bm25, "PART_BYTES", 1_000)
    monkeypatch.setattr(bm25, "SHARD_ROWS", 30)
    assert sorted(map(tuple, bm25.top_k(df, asked, 5).collect())) == want
    searched = [plan for name, plan in plans if name == "bm25-found"]
    assert len(searched) == 3 and not any(x in plan for plan in searched for x in ("Exchange", "Generate", "Join"))


def test_bm25_batches_and_pruned_search_agree(monkeypatch):
    """Queries scored in batches by matrix and lists give what the pruned search of each gives, bit for bit, shard after shard."""
    monkeypatch.setattr(bm25, "BLOCK", 4)
    monkeypatch.setattr(bm25, "FIRST", 2)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(w)}" for w in rng.zipf(1.3, int(n)) if w < 900) for n in rng.integers(0, 70, 400)]
    texts[7] = texts[9] = texts[200] = texts[390]
    ids = rng.permutation(400) // 2
    asked = np.unique(bm25.term_ids({w for t in texts for w in bm25.words_of(t)}))
    idfs = rng.random(len(asked)) * 5 + 0.1
    terms = [np.searchsorted(asked, np.unique(bm25.term_ids(set(bm25.words_of(t))))) for t in texts[::3]]
    place, at = np.concatenate(terms).astype(np.int32), np.append(0, np.cumsum([len(t) for t in terms]))
    shards = [bm25.Index(ids[lo:lo + 150], texts[lo:lo + 150], 25.0, asked, idfs) for lo in range(0, 400, 150)]
    for k in (1, 5, 30):
        whole = [sorted((-s, d) for x in shards for s, d in x.search(t, k))[:k] for t in terms]
        for batch, lists, common, matrix, pruned in ((512, 64, 0.03, 1024, 0), (7, 3, 0.2, 1024, 0), (64, 64, 0.01, 4, 0), (64, 8, 2, 9, 0), (64, 64, 0, 1024, 1)):
            for name, value in (("BATCH", batch), ("LISTS", lists), ("COMMON", common), ("MATRIX", matrix), ("PRUNED", pruned)):
                monkeypatch.setattr(bm25, name, value)
            best = bm25.Best(len(terms), k)
            for x in shards:
                best.search(x, place, at)
            assert best.rows == whole


def test_bm25_words_and_pruned_search(monkeypatch):
    """ASCII white space alone divides words, A-Z alone are lower-cased; scores
    are the same whether blocks are skipped, picked or read as whole lists."""
    text = "A\x1cb\x85c\u00a0D\u00c9 \t\n\x0b\x0c\r e\x1f\u0130"
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    assert [w.decode() for w in bm25.words_of(text)] == re.findall("[^\\x20\\x09-\\x0D]+", low)
    monkeypatch.setattr(bm25, "BLOCK", 4)
    monkeypatch.setattr(bm25, "FIRST", 2)
    monkeypatch.setattr(bm25, "HELD", 50)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(w)}" for w in rng.zipf(1.4, int(n)) if w < 400) for n in rng.integers(0, 60, 300)]
    texts[7] = texts[9] = texts[200]
    asked = np.unique(bm25.term_ids({w for t in texts for w in bm25.words_of(t)}))
    idfs = rng.random(len(asked)) + 0.1
    index = bm25.Index(np.arange(300), texts, 25.0, asked, idfs)
    for q in range(0, 300, 7):
        terms = np.searchsorted(asked, np.unique(bm25.term_ids(set(bm25.words_of(texts[q])))))
        want = []
        for d, t in enumerate(texts):
            words = bm25.words_of(t)
            tf = {int(np.searchsorted(asked, bm25.term_ids([w])[0])): words.count(w) for w in set(words)}
            norm = bm25.K1 * (1 - bm25.B + bm25.B * len(words) / 25.0)
            score = sum(tf[i] * (bm25.K1 + 1) / (tf[i] + norm) * idfs[i] for i in terms.tolist() if i in tf)
            if score:
                want.append((-score, d))
        want.sort()
        for k in (1, 5, 400):
            got = index.search(terms, k)
            assert [d for _, d in got] == [d for _, d in want[:k]]
            assert np.allclose([s for s, _ in got], [-s for s, _ in want[:k]])


def test_vector_recall_and_ties(spark):
    con = duckdb.connect()
    rows = con.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    rows += [(10_000 + i, rows[40][1]) for i in range(60)] + [(20_000, None), (20_001, [0.0] * 64), (20_002, [float("nan")] * 64),
                                                             (20_020, [2.0 * x for x in rows[0][1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, 20).collect()
    ok = [(i, np.asarray(v, np.float32).astype(float)) for i, v in rows if v is not None and np.isfinite(v).all() and any(v)]
    hit = total = 0
    for q, v in ok:
        if q % 20 == 0:
            want = sorted(((-float(np.dot(v, x)), i) for i, x in ok if i != q))[:20]
            have = [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
            assert len(have) == 20 and [s for _, s in have] == sorted((s for _, s in have), reverse=True)
            hit += len({i for i, _ in have} & {i for _, i in want})
            total += 20
    assert hit / total >= 0.9
    copies = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 40), key=lambda r: r["rank"])]
    assert copies == list(range(10_000, 10_020)) or copies[0] == 20_020


def test_vectors_of_repeated_ids():
    rng = np.random.default_rng(3)
    far = rng.standard_normal((300, 8)) * 0.1
    one = rng.standard_normal(8)
    ids = np.concatenate([np.full(21, 20), np.arange(1001, 1031), np.arange(2000, 2300), np.full(30, 20)])
    vectors = np.vstack([np.tile(one, (51, 1)), far, one + rng.standard_normal((30, 8)) * 0.01])
    found = ann.Shard(ids, vectors, 20).search(one, 20)
    assert [v for _, v in found] == list(range(1001, 1021))
    alone = ann.Shard(ids[[*range(21), *range(51, 381)]], vectors[[*range(21), *range(51, 381)]], 20).search(one, 20)
    assert len(alone) == 20 and all(v >= 2000 for _, v in alone)
    assert {v for _, v in ann.Shard(ids, vectors, 20).search(one, 1001)} == {20}


def test_toxicity_held_out(spark):
    got = queries.op7_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.1/labels.parquet'").df()
    held = got.merge(labels, on="doc_id")
    held = held[held.held_out]
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    hit, said, real = ((held.predicted == 1) & (held.toxic == 1)).sum(), (held.predicted == 1).sum(), (held.toxic == 1).sum()
    assert hit / said >= 0.9 and hit / real >= 0.9
    assert got.score.between(0, 1).all()


def test_toxicity_folding_and_exceptions():
    m = toxicity.Matcher(toxicity.Model({"moron": 3.0, "scum": 2.0}, ("scumble", "scum of pond")))
    def hits(t):
        return sum(m.hits(f" {' '.join(toxicity.words_of(t))} ").values())
    assert hits("You MОRОN") == 3.0 and hits("m0r0n!!") == 3.0 and hits("mo​ron") == 3.0
    assert hits("scumble") == 0 and hits("scum of pond") == 0 and hits("scum") == 2.0 and hits("oxymoron") == 0


def test_sentencepiece(spark, docs):
    v = spm.Vocabulary(spm.model_bytes())
    texts = ["", " ", "a", "  two  spaces ", "line\nbreak\ttab", "▁literal mark▁", "日本語 😀 é", "x" * 5000,
             "".join(invented(1).values()), "don't, stop. e.g. 3.14!"]

    def best(s):  # whole lattice at once
        score = [0.0] + [-1e300] * len(s)
        for j in range(1, len(s) + 1):
            for i in range(max(0, j - v.longest), j):
                hit = v.pieces.get(s[i:j])
                worth = hit[1] if hit else (v.unknown if j == i + 1 else None)
                if worth is not None:
                    score[j] = max(score[j], score[i] + worth)
        return score[-1]

    worth = {i: s for i, s in v.pieces.values()}
    for t in texts:
        ids = v.encode(t)
        assert v.decode(ids) == t
        assert [i for run in v.encode_stream(t) for i in run] == list(ids)
        if t and "▁" not in t:
            s = spm.MARK + t.replace(" ", spm.MARK)
            known = sum(worth[i] for i in ids if i in worth)
            unknown = sum(1 for c in s if c not in v.pieces)
            assert known + unknown * v.unknown == pytest.approx(best(s))
    rows = spm.encode(docs(dict(enumerate([*texts, None]))), spm.model_bytes())
    assert all(r["round_trip"] for r in rows.collect())
    back = {r["doc_id"]: r["text"] for r in spm.decode(rows, spm.model_bytes()).collect()}
    assert back == {**dict(enumerate(texts)), len(texts): ""}


def test_chat(spark):
    rows = [(1, 0, "user", "a </s> \\ b"), (1, 1, "assistant", "[INST] <|im_end|>"), (1, 2, "assistant", None), (1, 2, "assistant", None),
            (2, 0, "sy\nstem", "x"), (None, None, None, "t"), (3, 5, "assistant", "é\\["), (3, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    got = {r["conv_id"]: r for r in chat.digests(chat.transcripts(df)).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        body = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(body.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    shown = chat.render_examples(chat.transcripts(df)).filter("conv_id = 1").orderBy("example_id").collect()
    assert len(shown) == 3 and shown[1]["text"].startswith(shown[0]["text"])
    assert chat.unescape_text(shown[0]["text"][shown[0]["loss_start"]:shown[0]["loss_end"]]) == "[INST] <|im_end|>"
    for s in shown:
        inner = s["text"][s["loss_start"]:s["loss_end"]]
        assert not any(c in inner for c in chat.CONTROLS)


@pytest.mark.parametrize("block", [None, chat.BLOCK, 60, 1])
def test_chat_is_read_back_from_expanded_examples(spark, monkeypatch, block):
    """One text per assistant turn, every turn before it in it; with blocks, from the block's start."""
    close = chat.CLOSE
    rows = [(c, t, "assistant" if t % 3 == 1 else "user", f"{close * (t % 2)}é<|im_end|\\ {t}" * (t % 4)) for c in (1, None) for t in range(9)]
    rows += [(2, 0, "user", "no reply <|im_end|>\n<"), (2, 1, "a<|im_end|>\n", "neither")]
    script = chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    segments = {(r["conv_id"], r["seq"]): r for r in script.collect()}
    made = [r for r in chat.examples(script, block).collect() if r["example_id"] is not None]
    assert sorted((r["conv_id"] or 0, r["seq"], r["example_id"]) for r in made) == [(c, t, t // 3) for c in (0, 1) for t in (1, 4, 7)]
    for r in made:
        whole = "".join(segments[r["conv_id"], k]["segment"] for k in range(r["seq"] + 1))
        begin = min(s["char_start"] for (c, k), s in segments.items() if c == r["conv_id"] and k <= r["seq"]
                    and (block is None or s["char_start"] // block == segments[c, r["seq"]]["char_start"] // block))
        assert (r["text_start"], r["text"]) == (begin, whole[begin:])
    got = {r["conv_id"]: r for r in chat.digests(script, block).collect()}
    for c in (1, 2, None):
        turns = [(r, t) for k, _, r, t in rows if k == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_sha256"]) == (len(turns), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c]["formatted_chars"] == sum(len(s["segment"]) for (k, _), s in segments.items() if k == c)
    expand = chat.examples
    monkeypatch.setattr(chat, "examples", lambda *a: expand(*a).filter("example_id IS NULL OR example_id <> 1"))
    assert {r["n_examples"] for r in chat.digests(script, block).collect()} == {2, 0}


def test_chat_examples_are_whole_however_long(spark, monkeypatch):
    """Every example begins with its conversation, also beyond 2^18 code points and where pieces of few examples are dealt out."""
    monkeypatch.setattr(chat, "PIECE", 2)
    rows = [(c, t, "assistant" if t % 2 else "user", f"é{t}\\" * (20_000 if c == 1 else 2)) for c in (1, None) for t in range(13)]
    rows += [(2, t, "user", f"no reply {t}") for t in range(3)] + [(3, t, "assistant", f"{t}") for t in range(4)] + [(3, 4, "user", "end")]
    script = chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    segments = {(r["conv_id"], r["seq"]): r["segment"] for r in script.collect()}
    assert sum(len(s) for (c, _), s in segments.items() if c == 1) > 2 * chat.BLOCK
    made = []
    expand = chat.examples
    monkeypatch.setattr(chat, "examples", lambda *a: made.extend(expand(*a).collect()) or expand(*a))
    got = {r["conv_id"]: r for r in chat.digests(script).collect()}
    trained = [r for r in made if r["example_id"] is not None]
    assert sorted((r["conv_id"] or 0, r["seq"], r["example_id"]) for r in trained) == sorted(
        [(c, t, t // 2) for c in (0, 1) for t in range(1, 13, 2)] + [(3, t, t) for t in range(4)])
    for r in trained:
        assert (r["text_start"], r["text"]) == (0, "".join(segments[r["conv_id"], k] for k in range(r["seq"] + 1)))
    assert sorted((r["conv_id"] or 0, r["seq"]) for r in made if r["example_id"] is None) == [(0, 12), (1, 12), (2, 0), (2, 1), (2, 2), (3, 4)]
    for c in (1, 2, 3, None):
        turns = [(r, t) for k, _, r, t in rows if k == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_sha256"]) == (len(turns), hashlib.sha256(loss.encode()).hexdigest())


def test_pages():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href='x'>menu</a></nav><div class='ad'>buy</div>"
            "<article><h1>Head &amp; line</h1><p>One <b>bo</b>ld,\n two.<br>three<p>Four&nbsp;five.<div class='comments'><p>no</p></div>"
            "<form>no</form><p>Six.</article><footer>foot</footer><script>var t='</p>';</script>")
    assert pagetext.main_text(page) == "Head & line One bold, two. three Four five. Six."
    plain = "<body><div id='sidebar'>links links</div><div class='text'><p>A long sentence, with marks. And more, here.</p><p>Short.</p></div></body>"
    assert pagetext.main_text(plain) == "A long sentence, with marks. And more, here. Short."
    assert pagetext.main_text(None) == pagetext.main_text("") == pagetext.main_text("<p></p>") == ""
    assert pagetext.main_text("just text &lt;3") == "just text <3"
    assert pagetext.main_text("<article><p>cut off <a hre") == "cut off"
    assert len(pagetext.main_text("<div>" * 20000 + "deep" + "</div>" * 20000)) == 4


def test_pages_without_article_keep_what_stands_beside_paragraphs():
    said = "A sentence, with marks. Another one, longer; and so on. " * 8
    beside = "<h1>A heading of the page</h1><ul><li>first point</li><li>second point</li></ul><blockquote><p>Quoted.</p></blockquote>" \
        "<table><tr><th>key</th><td>value</td></tr></table>"
    whole = "A heading of the page first point second point Quoted. key value"
    for wrap in ("<div>{}</div>", "<section><div>{}</div></section>", "{}"):
        page = "<body><nav>menu</nav>" + wrap.format(beside + f"<p>{said}</p>" * 10) + "<footer>foot</footer></body>"
        assert pagetext.main_text(page) == " ".join([whole] + [said.strip()] * 10)
    lists = f"<div><p>Intro.</p><ul>{f'<li>{said}</li>' * 5}</ul><p>Outro.</p></div>"
    assert pagetext.main_text(lists) == " ".join(["Intro."] + [said.strip()] * 5 + ["Outro."])


def test_pages_names_of_wrappers_do_not_exclude_the_text():
    said = "A sentence, with marks. Another one, longer; and so on. " * 8
    paras, whole = f"<p>{said}</p>" * 4, " ".join([said.strip()] * 4)
    side = "<div id='sidebar'><p>Links, here.</p></div><div class='comments'><p>Reply.</p></div>"
    for names in ("content-sidebar-wrap", "has-sidebar", "no-sidebar", "post comments-open", "search-result"):
        assert pagetext.main_text(f"<body><div class='{names}'><div>{paras}</div>{side}</div></body>") == whole
        assert pagetext.main_text(f"<body><div class='{names}'><article>{paras}</article>{side}</div></body>") == whole
        assert pagetext.main_text(f"<body><article class='{names}'>{paras}{side}</article></body>") == whole
    results = f"<div class='search-result'><article>{paras}</article></div>" * 3
    assert pagetext.main_text(f"<body>{results}</body>") == " ".join([whole] * 3)
    # What stands beside the text stays out.
    replies = f"<div id='comments'><article class='comment'>{paras * 5}</article></div>"
    assert pagetext.main_text(f"<body><div class='has-sidebar'><article>{paras}</article>{replies}</div></body>") == whole
    assert pagetext.main_text(f"<body><div>{paras}</div><div id='comments'><div>{paras * 5}</div></div></body>") == whole
    assert pagetext.main_text(f"<body><div class='ad'>{said}</div><article><p>Short.</p></article></body>") == "Short."
    for page in ("<div><div>{}</div>{}</div>", "<main><div>{}</div>{}</main>"):
        aside = f"<div id='sidebar'><div><p>{said}</p></div></div>"
        assert pagetext.main_text("<body>" + page.format(paras, aside) + "</body>") == whole


def test_mixing_targets(spark, docs):
    texts = [(i, "w " * (i % 7 + 1) if i % 11 else None) for i in range(300)]
    df = docs(texts, {i: None if i % 50 == 0 else f"s{i % 5}" for i in range(300)})
    plan = {r["source"]: r for r in mixing.mix(df).select("source", "source_size", "target").distinct().collect()}
    total = sum(r["source_size"] for r in plan.values())
    assert sum(r["target"] for r in plan.values()) == pytest.approx(total)
    assert all(r["target"] <= 3 * r["source_size"] + 1e-9 for r in plan.values())
    names = sorted((s for s in plan if s is not None)) + [None]
    free = {s: plan[s]["target"] / (i % 3 + 1) for i, s in enumerate(names) if plan[s]["target"] < 3 * plan[s]["source_size"]}
    assert max(free.values()) == pytest.approx(min(free.values()))
    once = mixing.emit(df)
    assert once.columns == df.columns and sorted(map(str, once.collect())) == sorted(map(str, mixing.emit(df).collect()))


def test_line_chunks_edge_cases(spark, docs):
    long = "\n".join(f"line {i} of a passage" for i in range(40))
    out = {r["doc_id"]: r for r in linechunks.dedup_lines(docs({1: long, 2: "own\n" + long + "\nend", 3: None, 4: "", 5: long})).collect()}
    assert out[1]["text"] == long and out[3]["text"] is None and out[4]["text"] == "" and out[4]["n_lines"] == 1
    assert out[2]["n_removed"] > 20 and out[2]["text"].startswith("own") and out[2]["text"].endswith("end")
    assert out[5]["n_removed"] >= out[2]["n_removed"]


def brute_runs(texts):
    """Kept lines of each document, from the list of all runs of two or more lines at every place."""
    lines = {i: t.split("\n") for i, t in texts.items()}
    places = {}
    for i in sorted(lines):
        for a in range(len(lines[i])):
            for b in range(a + 2, len(lines[i]) + 1):
                places.setdefault(tuple(lines[i][a:b]), []).append((i, a))
    gone = {(i, a + k) for run, at in places.items() for i, a in at for k in range(len(run))
            if any(x < i or (x == i and y + len(run) <= a) for x, y in at)}
    return {i: "\n".join(x for k, x in enumerate(ls) if (i, k) not in gone) for i, ls in lines.items()}


def test_line_runs_against_brute_force(spark, docs):
    rnd = random.Random(5)
    passages = [[f"p{k} line {i}" for i in range(rnd.randint(2, 7))] for k in range(12)]
    texts = {}
    for i in range(60):
        parts = [rnd.choice(passages) if rnd.random() < 0.6 else [f"own {i} {k}"] for k in range(rnd.randint(1, 5))]
        texts[i] = "\n".join(x for p in parts for x in p)
    texts |= {60: "a\na\na", 61: "b\nb\nb\nb\nb", 62: "own 62\np0 line 0\nown 62b", 63: ""}
    out = linechunks.dedup_runs(docs(texts), carry=("source",)).collect()
    assert {r["doc_id"]: r["text"] for r in out} == brute_runs(texts)
    assert all(r["n_lines"] == texts[r["doc_id"]].count("\n") + 1 and r["carry_0"] == "s" for r in out)
    # The pipeline's stage: two lines repeated between other lines go whole.
    import corpus_pipeline

    pair = {1: "x\nsame one\nsame two\ny", 2: "z\nsame one\nsame two\nw", 3: None}
    stage = corpus_pipeline.drop_repeated_lines(spark, docs(pair).select(*corpus_pipeline.COLUMNS), SF)
    assert {r["doc_id"]: r["text"] for r in stage.collect()} == {1: pair[1], 2: "z\nw", 3: None}


def test_empty_tables(spark, docs):
    none = docs({})
    assert neardup.near_duplicates(none, 3, 85).count() == 0
    assert mixing.mix(none).count() == 0 and linechunks.dedup_lines(none).count() == 0
    assert prefixfree.digests(prefixfree.remove_repeats(none)).count() == 0
    assert bm25.top_k(none, F.col("doc_id") % 2 == 0).count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 2 == 0).count() == 0
    assert chat.digests(chat.transcripts(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(none, toxicity.learn(none, labels)).count() == 0
    assert spm.encode(none, spm.model_bytes()).count() == 0


def test_pipeline_keeps_empty_rows_of_a_shared_id(spark, docs):
    import corpus_pipeline

    text = "one two three four five six seven eight nine ten"
    rows = docs([(1, text), (2, text), (2, ""), (3, "other words that stand alone here"), (None, text)])
    left = corpus_pipeline.drop_near_duplicates(spark, rows.select(*corpus_pipeline.COLUMNS), SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=str) == sorted(
        [(1, text), (2, ""), (3, "other words that stand alone here"), (None, text)], key=str)


def test_pipeline(spark):
    import corpus_pipeline

    docs_ = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        before = docs_
        docs_ = f(spark, docs_, SF)
        assert docs_.columns == corpus_pipeline.COLUMNS and before.columns == corpus_pipeline.COLUMNS
    assert all(r["round_trip"] for r in corpus_pipeline.run(spark, SF).collect())


def brute_chunks(rows):
    """Kept lines by (doc_id, text) of the chunk rule, read off its statement."""
    from hashlib import md5

    at, first = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, md5(r[1].encode()).hexdigest())):
        lines = text.split("\n")
        marks = [md5(x.encode()).digest() for x in lines]
        ends = [i for i in range(1, len(lines) + 1) if i == len(lines)
                or md5((marks[i - 2] if i > 1 else b"") + marks[i - 1]).hexdigest()[0] != "f"]
        cuts = [0, *ends]
        spans = sorted({(a, b) for n in (1, 2) for a, b in zip(cuts, cuts[n:]) if b - a > 1})
        gone = at.setdefault((doc, text), set())
        for a, b in spans:
            where = first.setdefault(tuple(lines[a:b]), (doc, text, b))
            if where[:2] != (doc, text) or a >= where[2]:
                gone.update(range(a, b))
    return {k: (len(g), "\n".join(x for i, x in enumerate(k[1].split("\n")) if i not in g)) for k, g in at.items()}


def test_line_chunks_against_brute_force(spark, docs):
    rnd = random.Random(11)
    passages = [[f"q{k} line {i}" for i in range(rnd.randint(2, 9))] for k in range(15)]
    rows = [(3, "a\na\na\na\na"), (3, "a\na\na\na\na"), (None, "no id\nstands first"), (9, "no id\nstands first"), (9, ""),
            (7, "shared id\none text"), (7, "shared id\none text\nand more")]
    for i in range(80):
        parts = [rnd.choice(passages) if rnd.random() < 0.6 else [f"own {i} {k}"] for k in range(rnd.randint(1, 6))]
        rows.append((i + 20, "\n".join(x for p in parts for x in p)))
    want = brute_chunks(rows)
    out = linechunks.dedup_lines(docs(rows)).collect()
    key = lambda x: (str(x[0]), *x[1:])
    assert sorted(((r["doc_id"], r["n_removed"], r["text"]) for r in out), key=key) == sorted(((d, *want[d, t]) for d, t in rows), key=key)
    # Nine of ten passages of three or more lines lose their inner lines where they repeat (sf0.01 of the given tables: all).
    texts = {i: "\n".join([f"x{i}", *passages[i % 15], f"y{i}"]) for i in range(300)}
    left = {r["doc_id"]: r["text"] for r in linechunks.dedup_lines(docs(texts)).collect()}
    long = [i for i in range(15, 300) if len(passages[i % 15]) > 2]
    assert sum(not set(passages[i % 15][1:-1]) & set(left[i].split("\n")) for i in long) >= 0.9 * len(long)
