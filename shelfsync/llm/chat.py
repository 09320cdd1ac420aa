"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one training example: all turns before it are
context and only that reply is trainable.  :func:`transcripts` formats the
turns and finds their offsets, :func:`examples` expands them to one text per
assistant turn (context ``[0, loss_start)``, trainable span ``[loss_start,
loss_end)``), and :func:`digests` reads the conversations back from these
texts.

Every example is made whole, from the start of its conversation, so the
expansion grows with the square of a conversation's length.  Callers may ask
for texts that begin with a block of the transcript instead (``block``); no
query does.

Control strings inside texts (and roles) are escaped reversibly: backslashes
are doubled, and a backslash is put after the first character of every
control string, so none is left whole.

Scale: turns are range-partitioned by (conv_id, turn, ...), so a conversation
that holds a third of all rows is dealt over many tasks; offsets are prefix
sums in two levels (within a range, then over the ranges of a conversation).
The expansion is dealt in pieces of ``PIECE`` examples, each with a copy of the
turns before it, so one conversation's examples are made by many tasks; a task
holds one example.  Its texts are read back as they come, and only the part
that an example adds to the one before is shuffled.  Only the digests run
through each conversation in order, as SHA-256 demands; they stream and hold
one row.  An example is one value, so a transcript with replies may not pass
Spark's 2 GB for a value.

Edge cases: null text or role is empty; turns are ordered by turn (nulls
first), then role, then text, and repeated rows all count; rows with a null
conv_id form one conversation of that name; a conversation without assistant
turns has a transcript but no example; an empty table gives an empty result;
other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window as W, functions as F

from shelfsync.llm.common import grouped, map_arrow, rows_of, stage

#: Control strings that no text may contain unescaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>", "<pad>",
            "<|im_start|>", "<|im_end|>", "<|endoftext|>")
OPEN, MID, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
ASSISTANT = "assistant"
#: Code points of a transcript after which the next turn begins a new block, for callers that ask for blocks.
BLOCK = 1 << 18
#: Examples of a conversation that are made in one task; rows and bytes of a batch of them.
PIECE, BATCH_ROWS, BATCH_BYTES = 1_024, 4_096, 8 << 20


def _control_pattern() -> str:
    return "(?=" + "|".join(re.escape(c) for c in CONTROLS) + ")(.)"


def escape(c):
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), _control_pattern(), "$1\\\\")


def escape_role(c):
    """A role ends at the first line break, so its own breaks are written ``\\n``."""
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_text(s: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", s)


def unescape_role(s: str) -> str:
    return re.sub(r"\\([\\n]?)", lambda m: "\n" if m[1] == "n" else m[1], s)


def turns_of(conversations: DataFrame) -> DataFrame:
    """Turns with roles and texts made whole (null: empty)."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))


def transcripts(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq, segment, char_start, char_end, example_id, loss_start,
    loss_end, replies_before, replies``: the formatted turns of every
    conversation, in order.

    Offsets count code points of the conversation's transcript;
    ``example_id`` and the loss span are null for turns that are not trained.
    ``replies`` are the trained turns of the conversation.
    """
    order = ["conv_id", "turn", "role", "text"]
    body = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(MID))
    seg = turns_of(conversations).select(
        *order, body.alias("head"), escape(F.col("text")).alias("esc"), (F.col("role") == ASSISTANT).alias("train"))
    seg = seg.select(*order, "train", F.concat("head", "esc", F.lit(CLOSE)).alias("segment"),
                     F.length("head").cast("long").alias("head_len"), F.length("esc").cast("long").alias("esc_len"))
    ranged = stage(seg.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
                   .withColumn("part", F.spark_partition_id()), "chat-ranges")
    size = (F.col("head_len") + F.col("esc_len") + F.lit(len(CLOSE))).cast("long")
    ranged = ranged.withColumn("size", size).withColumn("one", F.col("train").cast("long"))
    # A null conv_id in two columns without nulls: the join then keeps the windows' partitions, and no text moves for it.
    ranged = ranged.withColumn("conv", F.coalesce("conv_id", F.lit(0))).withColumn("none", F.col("conv_id").isNull())
    keys = ["conv", "none", "part"]
    parts = ranged.groupBy(*keys).agg(F.sum("size").alias("chars"), F.count(F.lit(1)).alias("rows"),
                                      F.sum("one").alias("trained"))
    before = W.partitionBy("conv", "none").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = parts.select(*keys, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b_{c}") for c in ("chars", "rows", "trained")],
                        F.sum("trained").over(W.partitionBy("conv", "none")).alias("replies"))
    upto = W.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order[1:]]) \
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.select(*keys, "conv_id", "train", "one", "segment", "head_len", "esc_len", "size",
                          F.sum("size").over(upto).alias("chars"), F.count(F.lit(1)).over(upto).alias("rows"),
                          F.sum("one").over(upto).alias("trained"))
    j = local.join(base, keys)
    start = F.col("b_chars") + F.col("chars") - F.col("size")
    loss = start + F.col("head_len")
    return j.select("conv_id", (F.col("b_rows") + F.col("rows") - 1).alias("seq"), "segment",
                    start.alias("char_start"), (start + F.col("size")).alias("char_end"),
                    F.when(F.col("train"), F.col("b_trained") + F.col("trained") - 1).alias("example_id"),
                    F.when(F.col("train"), loss).alias("loss_start"),
                    F.when(F.col("train"), loss + F.col("esc_len")).alias("loss_end"),
                    (F.col("b_trained") + F.col("trained") - F.col("one")).alias("replies_before"), "replies")


def _expand(batches):
    """Examples of the turns, which come sorted by (conv_id, piece, seq); turns
    that no example reaches as rows of their own text."""
    import pyarrow as pa

    cols = ("conv_id", "seq", "example_id", "text", "text_start", "added_from", "loss_start", "loss_end")
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    out: list[tuple] = []
    held = 0

    def flush():
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names=cols)
        out.clear()
        return made

    for (conv, _), rows in grouped(rows_of(batches), lambda r: r[:2]):
        text, begin, done = bytearray(), None, None
        for _, _, seq, example, segment, start, end, loss_start, loss_end, own, reached in rows:
            if not reached:
                row = (conv, seq, None, segment, start, start, None, None)
            else:
                begin = start if begin is None else begin
                text += segment
                since, done = (begin if done is None else done), (done if example is None else end)
                if example is None or not own:
                    continue
                row = (conv, seq, example, bytes(text), begin, since, loss_start, loss_end)
            if out and held + len(row[3]) > BATCH_BYTES or len(out) >= BATCH_ROWS:
                yield flush()
                held = 0
            out.append(row)
            held += len(row[3])
    if out:
        yield flush()


def examples(transcript: DataFrame, block: int | None = None) -> DataFrame:
    """Prefix-target expansion: ``conv_id, seq, example_id, text, text_start,
    added_from, loss_start, loss_end``, one row per assistant turn.

    ``text`` is the whole example, from the start of the transcript to the end
    of the reply (with ``block``: from the start of its block of so many code
    points, at ``text_start``); from ``added_from`` on it is in no example
    before.  Turns that no example (of their block) reaches follow as rows of
    their own text, their ``example_id`` and loss span null: those after a
    conversation's last reply, and context of examples in later blocks.
    """
    trained = F.col("example_id").isNotNull()
    if block is None:
        # A piece is some replies and the turns that lead to them; turns go to their own piece and to all later ones.
        own = F.floor(F.col("replies_before") / PIECE)
        last = F.floor((F.col("replies") - 1) / PIECE)
        rows = (transcript.withColumn("own", own).withColumn("piece", F.explode(F.sequence("own", F.greatest("own", last))))
                .withColumn("reached", F.col("replies_before") < F.col("replies")).repartition("conv_id", "piece"))
    else:
        of = W.partitionBy("conv_id", "own").orderBy("seq").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        rows = transcript.withColumn("own", F.floor(F.col("char_start") / block))
        rows = rows.withColumn("piece", F.col("own")).withColumn(
            "reached", F.coalesce(F.col("seq") <= F.max(F.when(trained, F.col("seq"))).over(of), F.lit(False)))
    rows = rows.select("conv_id", "piece", "seq", "example_id", F.encode("segment", "utf-8").alias("segment"), "char_start", "char_end",
                       "loss_start", "loss_end", (F.col("own") == F.col("piece")).alias("own"), "reached")
    return rows.sortWithinPartitions("conv_id", "piece", "seq").transform(
        map_arrow, _expand, "conv_id long, seq long, example_id long, text string, text_start long, added_from long, "
                            "loss_start long, loss_end long")


def render_examples(transcript: DataFrame) -> DataFrame:
    """Every example as one string: ``conv_id, example_id, text, loss_start,
    loss_end``.  Output grows with the square of a conversation's turns."""
    return (examples(transcript).filter(F.col("example_id").isNotNull())
            .select("conv_id", "example_id", "text", "loss_start", "loss_end"))


def _digest(batches):
    """Per conversation, read back from its examples: turns, trained text, digests."""
    import pyarrow as pa

    cols = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples")
    out: list[tuple] = []

    def flush():
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names=cols)
        out.clear()
        return made

    for conv, rows in grouped(rows_of(batches), lambda r: r[0]):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n = chars = loss_chars = examples = 0
        for _, _, added, loss_start, loss_end in rows:
            for segment in added.split(CLOSE)[:-1]:     # no text holds a whole control string
                head, _, text = segment[len(OPEN):].partition(MID)
                turns.update(f"{unescape_role(head)}\n{unescape_text(text)}\n".encode())
                n += 1
            chars += len(added)
            if loss_start is not None:
                trained = unescape_text(added[loss_start:loss_end])
                loss.update(trained.encode())
                loss_chars, examples = loss_chars + len(trained), examples + 1
        out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, examples))
        if len(out) >= 4096:
            yield flush()
    if out:
        yield flush()


def digests(transcript: DataFrame, block: int | None = None) -> DataFrame:
    """One row per conversation, read back from its examples: each gives the
    turns that it adds to the one before and the reply under its loss mask."""
    since = F.col("added_from")
    rows = examples(transcript, block).select(
        "conv_id", "seq", F.substr("text", (since - F.col("text_start") + 1).cast("int")).alias("added"),
        (F.col("loss_start") - since).alias("loss_start"), (F.col("loss_end") - since).alias("loss_end"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return rows.transform(map_arrow, _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long, n_examples long")
