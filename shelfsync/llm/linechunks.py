"""Line dedup by content-defined chunks of lines.

Every line is hashed; a rolling hash over the hashes of two neighbouring lines
decides whether a piece ends there, so boundaries follow the content and an
inserted line moves only the boundaries next to it.  A chunk reaches over two
neighbouring pieces, or is one piece of two or more lines, so chunks overlap
and every chunk has several lines.  A chunk that also stands at an earlier
place (smallest doc_id, nulls first, then text digest and line) without sharing
a line with it is removed, after its bytes were compared: the document loses
all lines of such chunks.  Boundaries are dense (15 of 16), for a repeated
passage loses the lines of its whole chunks only: one of two lines needs a
boundary before, in and after it.

:func:`dedup_lines` is held to this rule by its SQL.  :func:`dedup_runs`, the
pipeline's stage, is the same with a boundary after every line, so chunks are
all pairs of neighbouring lines: all pairs of a run that occurs earlier occur
earlier, and a repeated pair is a repeated run, so the lines removed are
exactly those of the maximal repeated runs of two or more lines.

Scale: lines are hashed once, into narrow rows (digest and place) that are
staged.  Digests are counted before the shuffle, and places are joined with the
repeated ones without any text, so a passage that a third of the documents
share is no hot group.  Documents with repeated chunks are then joined with
their places, and only the text of those chunks is compared; documents move
once more when the removals come back.  The joins are ordinary equi-joins, so
the adaptive skew join splits hot keys.

Edge cases: a null text has no lines, stays null and removes nothing; an
empty text is one empty line; rows equal in doc_id and text are one place and
are treated alike; rows sharing a doc_id but not the text are told apart by
the text's digest; an empty table gives an empty result; columns other than
doc_id and text are ignored unless carried.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, functions as F

from shelfsync.llm.common import map_arrow, rows_of, stage

#: A boundary falls where the rolling hash's first hex digit is one of these; with all of them, after every line.
BOUNDARY_DIGITS, EVERY_LINE = "0123456789abcde", "0123456789abcdef"


def chunks_of(text: str | None, digits: str = BOUNDARY_DIGITS) -> list[tuple[int, int, bytes]]:
    """(first line, line after the last, digest) of each chunk, in order."""
    if text is None:
        return []
    each = [md5(line.encode()).digest() for line in text.split("\n")]
    ends, before = [0], b""
    for i, here in enumerate(each, 1):
        # A line's rolling hash covers it and the line before (none before the first).
        if digits == EVERY_LINE or md5(before + here).hexdigest()[0] in digits:
            ends.append(i)
        before = here
    if ends[-1] < len(each):
        ends.append(len(each))
    spans = [(a, b) for a, b in zip(ends, ends[1:], strict=False) if b - a > 1] + list(zip(ends, ends[2:], strict=False))
    return [(a, b, md5(b"".join(each[a:b])).digest()) for a, b in spans]


def _chunks(digits: str):
    def run(batches):
        import pyarrow as pa

        types = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary())
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                out = [(doc, th, *chunk) for doc, text, th in rows_of([b.slice(lo, 1024)]) for chunk in chunks_of(text, digits)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                     names=["doc_id", "th", "at", "til", "h"])

    return run


def _texts(batches):
    """The text of each span of a document."""
    import pyarrow as pa

    types = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string())
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            out = []
            for doc, th, text, spans in rows_of([b.slice(lo, 256)]):
                lines = text.split("\n")
                out += [(doc, th, x["at"], x["til"], "\n".join(lines[x["at"]:x["til"]])) for x in spans]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=["doc_id", "th", "at", "til", "chunk"])


def removals(docs: DataFrame, digits: str = BOUNDARY_DIGITS) -> DataFrame:
    """``gid, gth, gone`` (spans of lines) of the documents that lose any."""
    # Rows equal in doc_id and text are one place.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5("text").alias("th"))
    keyed = stage(rows.transform(map_arrow, _chunks(digits), "doc_id long, th string, at int, til int, h binary"), "line-chunks")
    repeated = (keyed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
                .select(F.col("h").alias("rh")))
    spans = (keyed.join(repeated, F.col("h") == F.col("rh"))
             .groupBy(F.col("doc_id").alias("sid"), F.col("th").alias("sth")).agg(F.collect_set(F.struct("at", "til")).alias("spans")))
    met = (rows.join(spans, F.col("doc_id").eqNullSafe(F.col("sid")) & (F.col("th") == F.col("sth")))
           .select("doc_id", "th", "text", "spans")
           .transform(map_arrow, _texts, "doc_id long, th string, at int, til int, chunk string"))
    met = stage(met.select(F.xxhash64("chunk").alias("h"), "chunk", F.struct("doc_id", "th", "at", "til").alias("place")), "line-chunk-texts")
    # Byte comparison: places are grouped by the chunk's text, not by its digest alone.
    first = met.groupBy("h", "chunk").agg(F.min("place").alias("first"))
    first = first.select(F.col("h").alias("fh"), F.col("chunk").alias("fchunk"), "first")
    # Chunks that share a line are no repeated passage ("a a a"); nor is a chunk's own first place.
    beside = (F.col("place.doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("place.th") == F.col("first.th"))
              & (F.col("place.at") < F.col("first.til")))
    gone = met.join(first, (F.col("h") == F.col("fh")) & (F.col("chunk") == F.col("fchunk"))).filter(~beside)
    return (gone.groupBy(F.col("place.doc_id").alias("gid"), F.col("place.th").alias("gth"))
            .agg(F.collect_set(F.struct("place.at", "place.til")).alias("gone")))


def _without(text: str | None, spans: list) -> tuple[int, int, str | None]:
    """Lines, lines removed and remaining text."""
    lines = [] if text is None else text.split("\n")
    cut = {i for x in spans for i in range(x["at"], x["til"])}
    return len(lines), len(cut), text if not cut else "\n".join(x for i, x in enumerate(lines) if i not in cut)


def _kept(batches):
    import pyarrow as pa

    for whole in batches:
        for lo in range(0, whole.num_rows, 1024):
            b = whole.slice(lo, 1024)
            n, lost, kept = [], [], []
            for text, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                a, c, left = _without(text, gone or [])
                n.append(a)
                lost.append(c)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string()), *b.columns[3:]],
                names=["doc_id", "n_lines", "n_removed", "text", *b.schema.names[3:]])


def _less(docs: DataFrame, removed: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5("text").alias("th"),
                       *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    rows = rows.join(removed, F.col("doc_id").eqNullSafe(F.col("gid")) & (F.col("th") == F.col("gth")), "left")
    rows = rows.select("doc_id", "text", "gone", *[f"carry_{i}" for i in range(len(carry))])
    carried = "".join(f", carry_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    return rows.transform(map_arrow, _kept, "doc_id long, n_lines long, n_removed long, text string" + carried)


def dedup_lines(docs: DataFrame, carry: tuple[str, ...] = (), digits: str = BOUNDARY_DIGITS) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, text`` (what stays)
    and the columns named in ``carry`` as ``carry_0, carry_1, ...``."""
    return _less(docs, removals(docs, digits), carry)


def dedup_runs(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """As :func:`dedup_lines`, with a boundary after every line: without the
    lines of any repeated run of two or more lines."""
    return dedup_lines(docs, carry, EVERY_LINE)


#: DuckDB SQL for :func:`dedup_lines`.
LINES_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, md5(text) AS th, string_split(text, chr(10)) AS ls FROM {docs}),
l AS (SELECT r, doc_id, th, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
roll AS (SELECT *, substr(md5(coalesce(unhex(md5(lag(line) OVER w)), ''::BLOB) || unhex(md5(line))), 1, 1) <> 'f' AS last
         FROM l WINDOW w AS (PARTITION BY r ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(last::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
             FROM roll),
pieces AS (SELECT r, doc_id, th, pos, min(i) AS lo, max(i) AS hi, string_agg(line, chr(10) ORDER BY i) AS piece
           FROM numbered GROUP BY r, doc_id, th, pos),
paired AS (SELECT *, lead(hi) OVER w AS hi2, lead(piece) OVER w AS piece2 FROM pieces WINDOW w AS (PARTITION BY r ORDER BY pos)),
chunks AS (SELECT r, doc_id, th, lo, hi, piece AS chunk FROM pieces WHERE hi > lo
           UNION ALL SELECT r, doc_id, th, lo, hi2, piece || chr(10) || piece2 FROM paired WHERE hi2 IS NOT NULL),
placed AS (SELECT r, doc_id, th, lo, hi, first_value(doc_id) OVER w AS fdoc, first_value(th) OVER w AS fth, first_value(hi) OVER w AS fhi
           FROM chunks WINDOW w AS (PARTITION BY chunk ORDER BY doc_id NULLS FIRST, th, lo)),
gone AS (SELECT DISTINCT r, unnest(range(lo, hi + 1)) AS i FROM placed
         WHERE NOT (doc_id IS NOT DISTINCT FROM fdoc AND th = fth AND lo <= fhi)),
kept AS (SELECT l.r, count(gone.i) AS n_removed, string_agg(CASE WHEN gone.i IS NULL THEN line END, chr(10) ORDER BY l.i) AS text
         FROM l LEFT JOIN gone ON l.r = gone.r AND l.i = gone.i GROUP BY l.r)
SELECT d.doc_id, coalesce(len(d.ls), 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM d LEFT JOIN kept k ON d.r = k.r
"""
