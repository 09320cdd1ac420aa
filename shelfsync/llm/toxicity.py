"""Toxicity by a weighted lexicon with exception phrases.

Texts are folded (compatibility forms, homoglyphs, invisible characters, digit
and sign substitutions, case), cut into words, and matched by one
Aho-Corasick pass against a lexicon of word beginnings.  A match inside an
exception phrase does not count.  The sum of matched weights, normalised by
length, is turned into a probability.

The lexicon, the exceptions and the scale are learned from labelled rows: at
most ``max_train`` of them, chosen by a hash of the doc_id (a documented bound;
matching covers every row and whole texts).  Word beginnings and words are
counted per document; a log-likelihood ratio test selects (its threshold grows
with the number of candidates, so that few or many labels let in as few chance
entries), the log ratio of token rates weighs.  Longer forms of a lexicon
entry that belong to clean texts become exceptions.  A rising curve from the
normalised sum to the share of toxic texts is fitted on a histogram (isotonic
regression).

Scale: one pass over the corpus to fetch the training sample, one to score, no
shuffle of texts.  The model holds every entry that passes the test; it is
bounded by the words of the sample and travels in the task's closure.  Labels
of the bounded training sample are broadcast (``max_train`` rows of 16 bytes).

Edge cases: null or empty text has no words and scores what a text without
matches scores; rows with a null doc_id are scored but never trained on;
without labels of both kinds every text scores 0; repeated rows score alike;
labels, lang and source are never read by the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from shelfsync.llm.common import map_arrow, stage

THRESHOLD = 0.3
MAX_TRAIN = 20_000
#: Word beginnings of these lengths are candidates for the lexicon, and whole words of any.
STEMS = range(4, 9)
#: Chance entries that the lexicon may be expected to hold: with m candidates, an
#: entry's log-likelihood ratio must reach 2 ln(m / FALSE_ENTRIES).
FALSE_ENTRIES, MIN_RATIO = 1.0, 2.0
SMOOTH_WORDS = 20
BINS = 400

#: Letters of other scripts that look like Latin ones, signs used for letters, invisible characters.
LOOKALIKES = dict(zip("авекмнорстухіјѕԁԛԝһԍɡαεικνορτυχοϲϳ", "abekmhopctyxijsdqwhggaeikvoptuxocj", strict=True))
SIGNS = dict(zip("0134579@$€£", "oieastgasel", strict=True))
INVISIBLE = "".join(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))
_FOLD = str.maketrans({**LOOKALIKES, **SIGNS, **dict.fromkeys(INVISIBLE)})
_WORDS = re.compile(r"[^\W_]+")
_BANG = re.compile(r"(?<=[^\W\d_])!(?=[^\W\d_])")


def fold(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower().translate(_FOLD)
    return _BANG.sub("i", text) if "!" in text else text


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(fold(text)) if text else []


@dataclass(frozen=True)
class Model:
    """``lexicon``: word beginning -> weight (a trailing space marks a whole
    word); ``exceptions``: whole words or phrases whose matches do not count;
    ``curve``: rising (feature, probability) points, straight lines between."""

    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[tuple[float, float], ...] = ()


class Matcher:
    """The model as one automaton over ' word word ... word '."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.automaton = ahocorasick.Automaton()
        for k, w in model.lexicon.items():
            self.automaton.add_word(f" {k}", (len(k) + 1, w))
        for k in model.exceptions:
            self.automaton.add_word(f" {k} ", (len(k) + 2, None))
        self.ready = bool(model.lexicon)
        if self.ready:
            self.automaton.make_automaton()

    def hits(self, line: str) -> dict[int, float]:
        """Start of a word -> weight of its longest entry, exceptions taken out."""
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton.iter(line):
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            else:
                found[start] = weight
        for a, b in spared:
            for s in [s for s in found if a <= s < b] if len(found) < b - a else [s for s in range(a, b) if s in found]:
                del found[s]
        return found

    def density(self, words: list[str]) -> float:
        if not self.ready or not words:
            return 0.0
        return sum(self.hits(f" {' '.join(words)} ").values()) / (len(words) + SMOOTH_WORDS)

    def score(self, text: str | None) -> float:
        curve = self.model.curve
        if not self.ready or not curve:
            return 0.0
        x = _feature(self.density(words_of(text)))
        i = bisect_left(curve, (x, -1.0))
        if i == 0 or i == len(curve):
            return curve[min(i, len(curve) - 1)][1]
        (x0, p0), (x1, p1) = curve[i - 1], curve[i]
        return p0 + (p1 - p0) * (x - x0) / (x1 - x0)


def _feature(density: float) -> float:
    return math.log(1e-3 + max(density, 0.0))


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """``text, toxic`` of at most ``max_train`` labelled rows outside the held-out fold."""
    picked = (labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter(F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("label_id")))
              .orderBy(F.md5(F.col("label_id").cast("string")), "toxic").limit(max_train))
    return docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("label_id")).select("text", "toxic")


def _counted(kind):
    """Arrow job: (feature, toxic docs, clean docs, toxic tokens, clean tokens) summed per batch.

    The feature '' counts documents and words."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            docs, tokens = (Counter(), Counter()), (Counter(), Counter())
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = words_of(text)
                got = kind(words)
                docs[1 - toxic].update(got.keys())
                tokens[1 - toxic].update(got)
                docs[1 - toxic][""] += 1
                tokens[1 - toxic][""] += len(words)
            keys = list(docs[0].keys() | docs[1].keys())
            cols = [pa.array(keys, pa.string())] + [pa.array([c[k] for k in keys], pa.int64()) for c in (*docs, *tokens)]
            yield pa.RecordBatch.from_arrays(cols, names=["f", "dt", "dc", "tt", "tc"])

    return run


def _stems(words: list[str]) -> Counter:
    got: Counter = Counter()
    for w, n in Counter(words).items():
        for k in STEMS:
            if len(w) > k:
                got[w[:k]] += n
        got[f"{w} "] += n
    return got


def _sums(train: DataFrame, kind) -> DataFrame:
    return (train.transform(map_arrow, _counted(kind), "f string, dt long, dc long, tt long, tc long")
            .groupBy("f").agg(*[F.sum(c).alias(c) for c in ("dt", "dc", "tt", "tc")]))


def _ratio(tt, tc, words_t, words_c):
    return F.log((F.col(tt) + 0.5) / (words_t + 1.0)) - F.log((F.col(tc) + 0.5) / (words_c + 1.0))


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """The model from the bounded training sample of ``labels``, read once and
    kept.  Lexicon and exceptions hold all that pass: at most the sample's words."""
    train = stage(training_rows(docs, labels, max_train), "toxicity-train")
    sums = stage(_sums(train, _stems), "toxicity-sums")
    least = 2 * math.log(max(sums.count(), 2) / FALSE_ENTRIES)
    total = sums.filter(F.col("f") == "").first()
    if total is None or not total["dt"] or not total["dc"]:
        return Model()
    nt, nc, wt, wc = total["dt"], total["dc"], total["tt"], total["tc"]

    def cell(o, row, col):  # o * log(o / expected), 0 at o = 0
        return F.when(o > 0, o * F.log(o / (row * col / float(nt + nc)))).otherwise(0.0)

    both = F.col("dt") + F.col("dc")
    g2 = 2 * (cell(F.col("dt"), both, F.lit(float(nt))) + cell(F.col("dc"), both, F.lit(float(nc)))
              + cell(F.lit(nt) - F.col("dt"), F.lit(nt + nc) - both, F.lit(float(nt)))
              + cell(F.lit(nc) - F.col("dc"), F.lit(nt + nc) - both, F.lit(float(nc))))
    entries = (sums.filter(F.col("f") != "").withColumn("w", _ratio("tt", "tc", wt, wc)).withColumn("g2", g2)
               .filter((F.col("w") >= MIN_RATIO) & (F.col("g2") >= least) & (F.col("dt") * nc > F.col("dc") * nt))
               .orderBy(F.desc("g2"), "f").select("f", "w").collect())
    lexicon = {r["f"]: float(r["w"]) for r in entries}
    if not lexicon:
        return Model()
    plain = Matcher(Model(lexicon))

    def phrases(words: list[str]) -> Counter:
        got: Counter = Counter()
        line, at = f" {' '.join(words)} ", {}
        pos = 0
        for i, w in enumerate(words):
            at[pos] = i
            pos += len(w) + 1
        for start in plain.hits(line):
            i = at[start]
            got[words[i]] += 1
            if i + 1 < len(words):
                got[f"{words[i]} {words[i + 1]}"] += 1
            if i:
                got[f"{words[i - 1]} {words[i]}"] += 1
        return got

    spared = (_sums(train, phrases).filter((F.col("f") != "") & (F.col("dc") >= 5) & (_ratio("tt", "tc", wt, wc) < 0))
              .orderBy(F.desc("dc"), "f").select("f").collect())
    model = Model(lexicon, tuple(r["f"] for r in spared))
    return _calibrated(train, model)


def _calibrated(train: DataFrame, model: Model) -> Model:
    """The model with its curve, fitted on a histogram of the feature."""
    matcher_model = model
    low, high = _feature(0.0), _feature(10.0)

    def run(batches):
        import pyarrow as pa

        matcher = Matcher(matcher_model)
        for b in batches:
            n: Counter = Counter()
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                z = _feature(matcher.density(words_of(text)))
                n[min(BINS - 1, int((z - low) / (high - low) * BINS)), toxic] += 1
            cols = list(zip(*[(k[0], k[1], v) for k, v in n.items()], strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["bin", "toxic", "n"])

    hist = (train.transform(map_arrow, run, "bin long, toxic long, n long").groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect())
    blocks: list[list[float]] = []  # [toxic, texts, first feature, last feature], kept in rising order of the toxic share
    counts: dict[int, list[int]] = {}
    for r in hist:
        counts.setdefault(r["bin"], [0, 0])[r["toxic"]] += r["n"]
    for i in sorted(counts):
        clean, toxic = counts[i]
        x = low if i == 0 else low + (i + 0.5) * (high - low) / BINS
        blocks.append([toxic, clean + toxic, x, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    curve = tuple((x, (t + 0.05) / (n + 0.1)) for t, n, first, end in blocks for x in dict.fromkeys((first, end)))
    return Model(model.lexicon, model.exceptions, curve)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``, over whole texts."""

    def run(batches):
        import pyarrow as pa

        matcher = Matcher(model)
        for b in batches:
            made = [matcher.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_arrow, run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    cols = docs.columns

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        matcher = Matcher(model)
        at = cols.index("text")
        for b in batches:
            keep = pa.array([matcher.score(t) < THRESHOLD for t in b.column(at).to_pylist()], pa.bool_())
            yield b.filter(keep) if not pc.all(keep).as_py() else b

    return docs.transform(map_arrow, run, docs.schema)
