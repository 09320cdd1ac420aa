"""Encoding and decoding with a SentencePiece vocabulary by streaming Viterbi.

The best segmentation maximises the sum of piece scores.  The lattice is
walked once; a node is kept only while a piece may still reach past it (a
window of the longest piece) or while the surviving backpointer paths have not
met.  Where all of them run through one boundary, the ids before it are
committed and their nodes dropped, so memory follows the window, not the text.
No piece of the vocabulary spans from a letter into a following space (checked
when it is loaded), so every path meets before a word; committed words are
remembered in a bounded table.

White space: a space becomes the vocabulary's mark U+2581 and one is put in
front of a text.  Characters without a piece, and a literal U+2581, become
byte pieces, so decoding gives back every text exactly.

The vocabulary file is a parameter; the driver reads it and its bytes (half a
megabyte, bounded by the vocabulary) travel in the task's closure.  Texts are
encoded where they lie, without a shuffle.

Edge cases: null and empty texts have no ids (null decodes to null); repeated
rows are encoded alike; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from shelfsync.llm.common import map_arrow

MARK = "▁"
#: Stands for a literal U+2581 while encoding; no valid text holds a lone surrogate.
_LITERAL = "\ud800"
#: Added to the lowest score for a character without a piece, as unigram models do.
UNKNOWN_PENALTY = 10.0
REMEMBERED, LONGEST_REMEMBERED = 200_000, 64
#: Texts encoded between two Arrow batches.
ROWS = 512


def model_bytes(path: str | None = None) -> bytes:
    """The vocabulary file; by default the installed public 32k model."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Pieces, scores and byte pieces of a model; encodes and decodes."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.byte_ids: list[int] = [-1] * 256
        self.as_bytes: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            raw = b""
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                raw = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.pieces[piece] = (i, sp.get_score(i))
                raw = piece.replace(MARK, " ").encode()
            self.as_bytes.append(raw)
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte pieces: texts could not be given back")
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        self.words_meet = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces)
        # Every beginning of a piece: the piece's id and score if it is one itself.
        self._beginnings: dict[str, tuple[int, float] | tuple] = {p[:k]: () for p in self.pieces for k in range(1, len(p) + 1)}
        self._beginnings.update(self.pieces)
        self._known: dict[str, tuple[int, ...]] = {}
        # Nor does a piece span from a letter or digit into a sign, if so: words end before signs too.
        signs_meet = not any(re.search(r"[^\W_](?:[^\w%s]|_)" % MARK, p) for p in self.pieces)
        self._unit = re.compile(f"{MARK}*[^\\W_]+|{MARK}*(?:[^\\w{MARK}]|_)+|{MARK}+" if signs_meet else f"{MARK}*[^{MARK}]+|{MARK}+")
        self._single = frozenset(p for p in self.pieces if len(p) == 1)
        self._ends = ahocorasick.Automaton()
        for p, (i, score) in self.pieces.items():
            self._ends.add_word(p, (len(p), score, i))
        self._ends.make_automaton()

    def _unknown_ids(self, ch: str) -> list[int]:
        return [self.byte_ids[b] for b in (MARK if ch == _LITERAL else ch).encode()]

    def viterbi(self, s: str) -> Iterator[list[int]]:
        """Committed runs of ids of ``s`` (marks in place), in order."""
        beginning, longest = self._beginnings.get, self.longest
        best: dict[int, tuple[float, int, int]] = {0: (0.0, -1, -1)}  # boundary -> score, where from, piece
        start, reach, n = 0, 0, len(s)
        check = 4 * longest

        def commit(at: int) -> list[int]:
            back: list[int] = []
            ids: list[int] = []
            p = at
            while p > start:
                _, q, piece = best[p]
                back.append(p)
                ids.extend([piece] if piece >= 0 else reversed(self._unknown_ids(s[q:p])))
                p = q
            ids.reverse()
            return ids

        for i in range(n):
            if i > start and reach == i:  # every path ends on this boundary
                yield commit(i)
                best, start = {i: (0.0, -1, -1)}, i
            elif i - start >= check and i in best:
                live = {i, *(p for p in best if p > i)}
                heap = [-p for p in live]
                heapq.heapify(heap)
                while len(live) > 1:  # walk the furthest path back until one boundary is left
                    p = -heapq.heappop(heap)
                    live.discard(p)
                    q = best[p][1]
                    if q not in live:
                        live.add(q)
                        heapq.heappush(heap, -q)
                at = live.pop()
                if at > start:
                    yield commit(at)
                    base = best[at][0]
                    best = {p: (v[0] - base, v[1], v[2]) for p, v in best.items() if p >= at}
                    start = at
                check = max(4 * longest, 2 * (i - start))
            node = best.get(i)
            if node is None:
                continue
            here = node[0]
            single = False
            for j in range(i + 1, min(i + longest, n) + 1):
                hit = beginning(s[i:j])
                if hit is None:
                    break
                if hit:
                    single = single or j == i + 1
                    score = here + hit[1]
                    old = best.get(j)
                    if old is None or score > old[0]:
                        best[j] = (score, i, hit[0])
                        reach = max(reach, j)
            if not single:
                score, old = here + self.unknown, best.get(i + 1)
                if old is None or score > old[0]:
                    best[i + 1] = (score, i, -1)
                    reach = max(reach, i + 1)
        if n > start:
            yield commit(n)

    def _word(self, unit: str) -> tuple[int, ...]:
        """A word, whose end every path meets: the same walk, its window being the word."""
        if len(unit) > LONGEST_REMEMBERED:
            return tuple(i for run in self.viterbi(unit) for i in run)
        if not self._single.issuperset(unit):
            ids = tuple(i for run in self.viterbi(unit) for i in run)
            return self._remember(unit, ids)
        n = len(unit)
        score = [-1e300] * (n + 1)
        score[0] = 0.0
        back, piece = [0] * (n + 1), [-1] * (n + 1)
        for end, (length, worth, i) in self._ends.iter(unit):  # pieces by their end, the longest first
            end += 1
            new = score[end - length] + worth
            if new > score[end]:
                score[end], back[end], piece[end] = new, end - length, i
        out: list[int] = []
        while n:
            out.append(piece[n])
            n = back[n]
        out.reverse()
        return self._remember(unit, tuple(out))

    def _remember(self, unit: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        self._known[unit] = ids
        return ids

    def encode_stream(self, text: str) -> Iterator[tuple[int, ...] | list[int]]:
        """Runs of ids as they are committed."""
        if not text:
            return
        if MARK in text:
            text = text.replace(MARK, _LITERAL)
        s = MARK + text.replace(" ", MARK)
        if not self.words_meet:
            yield from self.viterbi(s)
            return
        known = self._known
        for m in self._unit.finditer(s):
            unit = m[0]
            ids = known.get(unit)
            if ids is not None:
                yield ids
            elif len(unit) <= LONGEST_REMEMBERED:
                yield self._word(unit)
            else:
                yield from self.viterbi(unit)

    def encode(self, text: str | None) -> array:
        """All ids of ``text``."""
        out = array("i")
        if not text:
            return out
        if MARK in text or not self.words_meet:
            for run in self.encode_stream(text):
                out.extend(run)
            return out
        s = MARK + text.replace(" ", MARK)
        known, word = self._known, self._word
        for unit in self._unit.findall(s):
            ids = known.get(unit)
            out.extend(word(unit) if ids is None else ids)
        return out

    def decode(self, ids) -> str:
        """The text of ``ids``."""
        raw = b"".join([self.as_bytes[i] for i in ids])
        return raw.decode("utf-8", "replace")[1:]


def _batches(model: bytes):
    def run(batches):
        import pyarrow as pa

        vocabulary = Vocabulary(model)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                flat, offsets, same = array("i"), [0], []
                for t in b.column(1):
                    text = t.as_py()
                    ids = vocabulary.encode(text)
                    same.append((vocabulary.decode(ids) == text) if text is not None else not ids)
                    flat.extend(ids)
                    offsets.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else np.empty(0, np.int32)))
                n = np.diff(np.asarray(offsets, np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), ids, pa.array(same, pa.bool_())],
                                                 names=["doc_id", "n_tokens", "ids", "round_trip"])

    return run


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip``: whole texts as ids, and whether they decode to the text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.transform(map_arrow, _batches(model), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids`` (null ids: null)."""

    def run(batches):
        import pyarrow as pa

        vocabulary = Vocabulary(model)
        for b in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").transform(map_arrow, run, "doc_id long, text string")
