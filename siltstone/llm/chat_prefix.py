r"""Chat formatting with prefix-target expansion.

A turn is written as `[INST]role\ntext[/INST]`, or `<s>text</s>` if an assistant speaks. Control strings
inside roles and texts are broken up by `\;` after their first character, after `\` is written `\\` (and
a line break in a role `\,`), so nothing in a text can pass for a marker and reading restores it exactly.

Every assistant turn becomes an example of its own: all turns before it are context, and only its text
is trainable. The formatted text of a context is a prefix of the formatted conversation, so the output
holds each formatted turn once (`piece`, starting at character `start` of its conversation), and on
assistant turns the example: its number, and the trainable span inside the piece. An example is then
"the first `start` characters of the conversation, then this piece". `expand` writes the examples out, each
with its whole context, for a training job; for a conversation of n turns these are up to n^2 / 2 pieces,
which stream from task to task and are not stored. `read_examples` reads the conversations back from them.

Positions come from a range partitioned, pinned table: each task counts inside its partition, and what a
conversation brings along from the partitions before is one small row per partition. Formatting needs no
whole conversation in a task; a written-out example does.

Nulls, blanks and ties: a null role or text is empty; turns are ordered by turn (null first), role and
text; rows may repeat; turns without conv_id are one conversation. A conversation without an assistant
has no example. Empty tables give empty results; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import pin

OPEN, CLOSE, SPEAK, STOP = "[INST]", "[/INST]", "<s>", "</s>"
CONTROLS = (OPEN, CLOSE, SPEAK, STOP)
ASSISTANT = "assistant"
_CONTROL = "(?=" + "|".join(re.escape(c) for c in CONTROLS) + ")(.)"
_PIECE = re.compile(r"\[INST\](.*?)\n(.*?)\[/INST\]|<s>(.*?)</s>", re.DOTALL)
_ESCAPE = re.compile(r"\\([\\;,])")


def escaped(text: str | Column) -> Column:
    """The text without control strings; `unescaped` restores it."""
    text = F.col(text) if isinstance(text, str) else text
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1\\;")


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: {"\\": "\\", ";": "", ",": "\n"}[m[1]], text)


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    found = _PIECE.fullmatch(piece)
    if not found:
        raise ValueError("not a formatted turn")
    if found[3] is not None:
        return ASSISTANT, unescaped(found[3])
    return unescaped(found[1]), unescaped(found[2])


_SCHEMA = "conv_id {kind}, pos bigint, start bigint, example bigint, piece string, target_start int, target_chars int, part int, at bigint"


def _placed(turns: DataFrame) -> DataFrame:
    """Pieces in global order with their place counted from the start of their partition."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, conv, pos, start, example = TaskContext.get().partitionId(), 0, object(), 0, 0, 0
        for batch in batches:
            out = []
            spoken = batch.column(2).to_pylist()
            for ident, size, speaks in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), spoken, strict=True):
                if ident != conv:
                    conv, pos, start, example = ident, 0, 0, 0
                out.append((pos, start, example if speaks else None, part, at))
                pos, start, example, at = pos + 1, start + size, example + bool(speaks), at + 1
            pos_, start_, example_, part_, at_ = (list(x) for x in zip(*out, strict=True)) if out else ([] for _ in range(5))
            head = [len(SPEAK) if s else None for s in spoken]
            long = [n - len(SPEAK) - len(STOP) if s else None for n, s in zip(batch.column(3).to_pylist(), spoken, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(pos_, pa.int64()), pa.array(start_, pa.int64()), pa.array(example_, pa.int64()), batch.column(1),
                    pa.array(head, pa.int32()), pa.array(long, pa.int32()), pa.array(part_, pa.int32()), pa.array(at_, pa.int64()),
                ],
                names=["conv_id", "pos", "start", "example", "piece", "target_start", "target_chars", "part", "at"],
            )

    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    speaks = role == ASSISTANT
    named = F.replace(escaped(role), F.lit("\n"), F.lit("\\,"))
    piece = F.when(speaks, F.concat(F.lit(SPEAK), escaped(text), F.lit(STOP))).otherwise(
        F.concat(F.lit(OPEN), named, F.lit("\n"), escaped(text), F.lit(CLOSE))
    )
    rows = turns.select("conv_id", "turn", piece.alias("piece"), speaks.alias("speaks"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "speaks", "piece"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("conv_id", "piece", "speaks", F.length("piece").alias("size"))
    return pin(rows.mapInArrow(run, _SCHEMA.format(kind=kind)), "turns")


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, start, piece, example, target_start, target_chars) per turn.

    `turns` has conv_id, turn, role, text. example, target_start and target_chars are null on turns that
    are context only; characters are code points.
    """
    placed = _placed(turns)
    ends = placed.groupBy("part").agg(
        F.min_by("conv_id", "at").alias("first"),
        F.max_by(F.struct("conv_id", (F.col("pos") + 1).alias("pos"), (F.col("start") + F.length("piece")).alias("start")), "at").alias("last"),
    )
    spoken = placed.groupBy("part", "conv_id").agg(F.count("example").alias("spoken"))
    last = F.col("last.conv_id")
    ends = ends.join(spoken.withColumnRenamed("part", "_p").withColumnRenamed("conv_id", "_c"), (F.col("part") == F.col("_p")) & last.eqNullSafe(F.col("_c")))
    rows = ends.select("part", "first", "last.*", "spoken").orderBy("part").collect()  # one row per partition
    carried, held = [], None
    for r in rows:
        before = held[1:] if held is not None and held[0] == r["first"] else (0, 0, 0)
        carried.append((r["part"], r["first"], *before))
        whole = r["first"] == r["conv_id"]  # one conversation fills the partition
        own = (r["pos"], r["start"], r["spoken"])
        held = (r["conv_id"], *(a + b if whole else b for a, b in zip(before, own, strict=True)))
    kind = turns.schema["conv_id"].dataType.simpleString()
    lookup = turns.sparkSession.createDataFrame(carried, f"part int, first {kind}, c_pos bigint, c_start bigint, c_example bigint")
    joined = placed.join(F.broadcast(lookup), "part", "left")
    goes_on = F.col("conv_id").eqNullSafe(F.col("first"))
    moved = {c: F.col(c) + F.when(goes_on, F.col(f"c_{c}")).otherwise(0) for c in ("pos", "start", "example")}
    return joined.select("conv_id", moved["pos"].alias("pos"), moved["start"].alias("start"), "piece", moved["example"].alias("example"), "target_start", "target_chars")


def _by_conversation(formatted: DataFrame) -> DataFrame:
    columns = ("conv_id", "pos", "start", "piece", "example", "target_start", "target_chars")
    return formatted.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "pos")


_BATCH_CHARS, _BATCH_ROWS = 1 << 20, 1000


def expand(formatted: DataFrame, max_context_chars: int | None = None, rest: bool = False) -> DataFrame:
    """(conv_id, example, context, target): every example written out, a conversation's examples in a row.

    With `max_context_chars` whole turns are left out from the start of the context until it fits. With `rest`
    a conversation with turns after its last target, or without any, ends with a row that has no example and
    no target, and the whole conversation as context; so the rows hold every turn.

    A task holds the formatted text of one conversation at a time, and writes it once per example.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            columns = list(zip(*out, strict=True))
            out.clear()
            held = 0
            types = [key, pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=["conv_id", "example", "context", "target"])

        conv, context, size, n, at, after = object(), [], 0, 0, 0, False
        for batch in batches:
            key = batch.column(0).type
            for ident, pos, start, piece, example, first, chars in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if ident != conv:
                    if rest and after:
                        out.append((conv, None, "".join(context), None))
                        held += size
                    conv, context, size, n, at = ident, [], 0, 0, 0
                if rest and (pos, start) != (n, at):
                    raise ValueError("formatted turns are not in a row")
                while max_context_chars is not None and context and size > max_context_chars:
                    size -= len(context.pop(0))
                if example is not None:
                    out.append((ident, example, "".join(context) + piece[:first], piece[first : first + chars]))
                    held += size + len(piece)
                after = example is None
                context.append(piece)
                size, n, at = size + len(piece), n + 1, at + len(piece)
                if held >= _BATCH_CHARS or len(out) >= _BATCH_ROWS:
                    yield flush()
        if rest and after:
            out.append((conv, None, "".join(context), None))
        if out:
            yield flush()

    return _by_conversation(formatted).mapInArrow(run, f"conv_id {kind}, example bigint, context string, target string")


_DIGEST = "conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_examples bigint"


def read_turns(text: str, start: int, end: int) -> Iterator[tuple[str, str]]:
    """Role and text of the formatted turns in a stretch of text."""
    while start < end:
        found = _PIECE.match(text, start, end)
        if not found:
            raise ValueError("not a formatted turn")
        yield read_piece(found[0])
        start = found.end()


def read_examples(examples: DataFrame) -> DataFrame:
    """Counts and digests per conversation, read from the examples that `expand` writes with `rest`.

    turns_sha256 is over role, line break, text, line break of every turn, as contexts and targets hold them;
    loss_* over the targets. Every context has to continue the examples before it: they are its prefix, and
    only what is new in it is read. A digest runs over a conversation from start to end, so its examples
    stream through one task, which holds one of them.
    """
    kind = examples.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            types = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=names)

        conv, open_ = None, False
        for batch in batches:
            key = batch.column(0).type
            for ident, example, context, target in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not open_ or ident != conv:
                    if open_:
                        done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), len(before), examples_))
                    conv, open_, before, n, loss_chars, examples_ = ident, True, "", 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                if not context.startswith(before) or (target is not None and (example != examples_ or not context.endswith(SPEAK))):
                    raise ValueError("examples do not continue each other")
                for role, text in read_turns(context, len(before), len(context) - (len(SPEAK) if target is not None else 0)):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                before = context
                if target is not None:
                    text = unescaped(target)
                    turns.update(f"{ASSISTANT}\n{text}\n".encode())
                    loss.update(text.encode())
                    n, loss_chars, examples_ = n + 1, loss_chars + len(text), examples_ + 1
                    before = f"{context}{target}{STOP}"
            if len(done) >= 5000:
                yield flush()
        if open_:
            done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), len(before), examples_))
            yield flush()

    return examples.mapInArrow(run, _DIGEST.format(kind=kind))


def read_back(formatted: DataFrame) -> DataFrame:
    """`read_examples` of all examples of formatted conversations."""
    return read_examples(expand(formatted, rest=True))
