"""Phrase collocations by top-order marginalisation.

Each word of a text leads one window: itself and the next ``ORDER - 1`` words
of its piece, padded with nulls where the piece ends.  Only these longest
windows are counted.  Spark's ROLLUP over (lang, w1, w2, w3) then sums them to
all their prefixes at once: the count of a phrase is the sum over the windows
that begin with it, so no shorter n-grams are ever made.

Scale: most windows hold words that are too rare together to lie in any
candidate.  What is too rare is found level by level: runs of two words are
counted by a 64-bit hash, pre-aggregated in the tasks, and those of
``MIN_COUNT`` or more set one bit each of a table of fixed size
(2 ** ``FILTER_BITS`` bits); then so are runs of three whose two pairs are set.
A window is padded from the first word with which its bit is not set.  Hashes
that clash only let a window stay longer, so counts stay exact at every size;
where far more runs are frequent than a table has bits, it just spares
less.  Tasks add up their own windows before the shuffle, and ROLLUP
pre-aggregates again, so a word, pair or line that holds a third of all rows
is one row a task.  A text streams through its task in slices.

A phrase's score is floor(1000000 a a / (l r)) at its lowest-scoring cut, in
decimals of 38 digits (exact for counts up to 10 ** 15).

Edge cases: null and empty texts have no words; a null lang is ``und``, and one
with the ``und`` of other rows; repeated rows count as often as they stand
there; ties in score go by count, then by phrase in byte order, so ranks are
definite; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfsync.llm.common import map_arrow, release, stage

ORDER, MIN_COUNT, TOP = 3, 10, 2000
#: A candidate is dropped where a longer one holds it with at least this percentage of its occurrences.
HELD_PERCENT = 50
FILTER_BITS = 26
#: The table is built in parts of so many bits.
PART_BITS = 15
#: Words of a step of work (at most 2 ** 20, so that numbers of words stay below 2 ** 21), and bytes of a text split at a time.
STEP, SLICE = 1 << 20, 4 << 20
#: A-Z are folded, these end a piece (written as a full stop), a tab parts words as a space does.
_ENDS = ".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans((string.ascii_uppercase + _ENDS + "\t").encode(),
                        (string.ascii_lowercase + "." * len(_ENDS) + " ").encode())


def words_of(text: str, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text and a full stop at each end of a piece, in slices."""
    folded = text.encode().translate(_FOLD)
    at = 0
    while at < len(folded):
        cut = len(folded)
        if cut - at > size:
            cut = folded.find(b" ", at + size)
            cut = len(folded) if cut < 0 else cut
        yield folded[at:cut].replace(b".", b" . ").split(b" ")
        at = cut
    yield [b"."]


class Vocabulary(dict):
    """Numbers for words as they come: 0 the empty word, 1 the end of a piece."""

    def __init__(self):
        super().__init__({b"": 0, b".": 1})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit mixing hash (wraps on purpose)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Step:
    """Some following words of a task: their numbers and langs; the last
    ``ORDER - 1`` only complete the windows before them."""

    def __init__(self, ids: np.ndarray, langs: np.ndarray, names: list[str], vocabulary: Vocabulary, lead: int):
        import xxhash

        self.ids, self.langs, self.names, self.lead = ids, langs, names, lead
        self.words = list(vocabulary)
        self.hashes = _mix(np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words)))
        self.lang_hashes = np.array([xxhash.xxh64_intdigest(x) for x in names], np.uint64)

    def runs(self, tables: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of 1 to ``most`` words: the hash of the run that begins at
        each place, and whether it may be frequent as far as ``tables`` tell."""
        with np.errstate(over="ignore"):
            h, may = self.hashes[self.ids] + self.lang_hashes[self.langs], self.ids > 1
            yield h, may
            for n in range(2, most + 1):
                h = _mix(h[:-1] * np.uint64(3) + self.hashes[self.ids[n - 1:]])
                may = may[:-1] & may[1:]
                if n - 2 < len(tables):
                    bit = h & np.uint64(64 * len(tables[n - 2]) - 1)
                    may &= ((tables[n - 2][bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)
                yield h, may

    def windows(self, tables: list[np.ndarray]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Of each lang: the distinct windows (a column of word numbers a place, 0: padded) and their counts."""
        code = np.zeros(self.lead, np.int64)
        for k, (_, may) in enumerate(self.runs(tables, ORDER)):
            code = (code << 21) | np.where(may[:self.lead], self.ids[k:k + self.lead], 0)
        word = self.ids[:self.lead] > 1
        for i, name in enumerate(self.names):
            distinct, n = np.unique(code[word & (self.langs[:self.lead] == i)], return_counts=True)
            yield name, np.stack([(distinct >> (21 * (ORDER - 1 - k))) & ((1 << 21) - 1) for k in range(ORDER)]), n


def steps(batches: Iterator, size: int, slices: int) -> Iterator[Step]:
    """The words of (lang, text) batches, about half of ``size`` a step."""
    vocabulary, names, ids, langs, held = Vocabulary(), {}, [], [], 0

    def step(last: bool) -> Iterator[Step]:
        nonlocal vocabulary, names, ids, langs, held
        all_ids, all_langs = np.concatenate(ids), np.concatenate(langs)
        keep = 0 if last else ORDER - 1
        lead = len(all_ids) - keep
        if last:  # the windows of the last words end at the ends of their pieces
            all_ids, all_langs = np.pad(all_ids, (0, ORDER - 1), constant_values=1), np.pad(all_langs, (0, ORDER - 1))
        one = Step(all_ids, all_langs, list(names), vocabulary, lead)
        yield one
        tail, tail_langs = all_ids[lead:], all_langs[lead:]
        if len(vocabulary) > size:
            vocabulary = Vocabulary()
            tail = np.array([vocabulary[one.words[i]] for i in tail], np.int64)
        ids, langs, held = [tail], [tail_langs], len(tail)

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            which = names.setdefault(lang, len(names))
            for words in words_of(text, slices):
                for at in range(0, len(words), size // 2):
                    part = words[at:at + size // 2]
                    found = np.fromiter(map(vocabulary.__getitem__, part), np.int64, len(part))
                    found = found[found > 0]
                    ids.append(found)
                    langs.append(np.full(len(found), which, np.int32))
                    held += len(found)
                    if held >= size // 2:
                        yield from step(False)
    if held:
        yield from step(True)


def _run_counts(n: int, tables: list, size: int, slices: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = [np.frombuffer(t.value, np.uint64) for t in tables]
        for s in steps(batches, size, slices):
            *_, (h, may) = s.runs(known, n)
            # The runs that begin among the words kept for the next step are counted there.
            runs, count = np.unique(h[:s.lead][may[:s.lead]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(count.astype(np.int64))], names=["h", "n"])

    return run


def _window_counts(tables: list, size: int, slices: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = [np.frombuffer(t.value, np.uint64) for t in tables]
        for s in steps(batches, size, slices):
            words = pa.array(s.words, pa.binary()).cast(pa.string())
            for lang, places, n in s.windows(known):
                for at in range(0, len(n), 1 << 17):
                    part = slice(at, at + (1 << 17))
                    cols = [words.take(pa.array(p[part], mask=p[part] == 0)) for p in places]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(cols[0]), pa.string()), *cols, pa.array(n[part].astype(np.int64))],
                        names=["lang", *_PLACES, "n"])

    return run


_PLACES = [f"w{k + 1}" for k in range(ORDER)]


def _part_of_table(size: int):
    def run(rows):
        import pyarrow as pa

        at = np.bincount(rows.column("at").to_numpy(), minlength=size).astype(bool)
        table = np.packbits(at, bitorder="little").tobytes()
        return pa.table([rows.column("part").slice(0, 1), pa.array([table], pa.binary())], names=["part", "bits"])

    return run


def frequent_runs(texts: DataFrame, n: int, tables: list) -> bytes:
    """The table of bits of the runs of ``n`` words that occur ``MIN_COUNT``
    times or more (by lang); ``tables`` are those of shorter runs."""
    runs = texts.transform(map_arrow, _run_counts(n, tables, STEP, SLICE), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    bits = min(FILTER_BITS, PART_BITS)
    bit = F.col("h").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    known = runs.filter(F.col("n") >= MIN_COUNT).select(F.shiftright(bit, bits).alias("part"), bit.bitwiseAND(F.lit((1 << bits) - 1)).alias("at"))
    # At most 2 ** (FILTER_BITS - PART_BITS) parts of a few kilobytes: the table is all that comes to the driver.
    parts = known.distinct().groupBy("part").applyInArrow(_part_of_table(1 << bits), "part long, bits binary").collect()
    size = (1 << bits) // 8
    out = bytearray((1 << FILTER_BITS) // 8)
    for r in parts:
        out[r["part"] * size:(r["part"] + 1) * size] = r["bits"]
    return bytes(out)


def phrase_counts(documents: DataFrame) -> DataFrame:
    """``lang, size, words, f`` of the phrases of 1 to ``ORDER`` words that
    occur ``MIN_COUNT`` times or more, and with size 0 each lang's count of all words."""
    spark = documents.sparkSession
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    tables: list = []
    for n in range(2, ORDER + 1):
        tables.append(spark.sparkContext.broadcast(frequent_runs(texts, n, tables)))
        release(spark)  # the counts are shuffled once each; their files go before the next are written
    windows = texts.transform(map_arrow, _window_counts(tables, STEP, SLICE),
                              "lang string, " + ", ".join(f"{w} string" for w in _PLACES) + ", n long")
    sums = windows.rollup("lang", *_PLACES).agg(F.sum("n").alias("f"), F.grouping_id().alias("gid"))
    size = F.lit(None).cast("int")
    for k in range(ORDER + 1):  # grouped by lang and the first k words; padded prefixes are no phrases
        whole = F.col(_PLACES[k - 1]).isNotNull() if k else F.lit(True)
        size = F.when((F.col("gid") == (1 << (ORDER - k)) - 1) & whole, F.lit(k)).otherwise(size)
    words = F.filter(F.array(*_PLACES), lambda x: x.isNotNull())
    return (sums.withColumn("size", size).filter(F.col("size").isNotNull() & ((F.col("f") >= MIN_COUNT) | (F.col("size") == 0)))
            .select("lang", "size", words.alias("words"), "f"))


def _phrase(words: Column, first, n) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly."""
    wide = "decimal(38,0)"
    num = (F.lit(1000000).cast("decimal(7,0)") * a.cast("decimal(15,0)") * a.cast("decimal(15,0)")).cast(wide)
    den = (l.cast("decimal(15,0)") * r.cast("decimal(15,0)")).cast(wide)
    return F.call_function("div", num, den)


def rank(counts: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of a staged :func:`phrase_counts`."""
    words = F.col("words")
    known = counts.filter("size > 0").select("lang", "size", "words", F.array_join("words", " ").alias("phrase"), "f")
    cands = known.filter("size > 1")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = (cands.select("lang", "phrase", "words", F.col("f").alias("a"), "size", cut.alias("k"))
            .select("lang", "phrase", "a", "k", _phrase(words, F.lit(1), F.col("k")).alias("left"),
                    _phrase(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("right")))
    part = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(part, ["lang", "left"]).join(rest, ["lang", "right"])
    lowest = F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    best = (scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest.alias("b"))
            .select("lang", "phrase", "a", "b.l", "b.r", "b.score"))
    inner = [F.struct(F.lit(m).alias("m"), F.lit(at).alias("at")) for m in range(2, ORDER) for at in range(1, ORDER - m + 2)]
    held = (cands.select("lang", "words", "size", "f", F.explode(F.array(*inner)).alias("p"))
            .filter((F.col("p.m") < F.col("size")) & (F.col("p.at") + F.col("p.m") - 1 <= F.col("size")))
            .select("lang", _phrase(words, F.col("p.at"), F.col("p.m")).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    free = best.join(held, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < HELD_PERCENT * F.col("a")))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    total = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(documents: DataFrame, top: int = TOP) -> DataFrame:
    """Each lang's ``top`` phrases by score."""
    return rank(stage(phrase_counts(documents), "phrase-counts"), top)


#: The same rows in DuckDB's SQL: lead windows, each prefix length summed on its own.
COLLOCATIONS_SQL = f"""
WITH p AS (SELECT lang, row_number() OVER () AS piece, pc FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[.,;:!?\\x0A-\\x0D]')) AS pc FROM {{docs}})),
w AS (SELECT lang, piece, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i
      FROM (SELECT lang, piece, regexp_extract_all(pc, '[^\\x20\\x09]+') AS ws FROM p)),
g AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
f AS (SELECT lang, 1 AS size, w1 AS phrase, w1 AS p1, NULL AS p2, NULL AS p3, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, w1, w2, NULL, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, w1, w2, w3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
c AS (SELECT * FROM f WHERE size > 1 AND f >= {MIN_COUNT}),
cuts AS (SELECT lang, phrase, f AS a, 1 AS k, p1 AS lft, concat_ws(' ', p2, p3) AS rgt FROM c
  UNION ALL SELECT lang, phrase, f, 2, p1 || ' ' || p2, p3 FROM c WHERE size = 3),
s AS (SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r,
  CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lft JOIN f y ON y.lang = cuts.lang AND y.phrase = rgt),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (SELECT lang, phrase, max(f) AS longer FROM (
  SELECT lang, p1 || ' ' || p2 AS phrase, f FROM c WHERE size = 3
  UNION ALL SELECT lang, p2 || ' ' || p3, f FROM c WHERE size = 3) GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN h USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {HELD_PERCENT} * a),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM k JOIN n USING (lang) QUALIFY rank <= {TOP}
"""
