"""Chat formatting by prefix-target expansion: every assistant turn becomes an
example of its own, whose context is all turns before it and whose only trainable
part is that reply.

Template: a turn is ``### <role>: <text></turn>\\n``.  In texts and roles ``\\`` is
written ``\\\\``, ``###`` as ``\\h`` and ``</turn>`` as ``\\t`` (in roles also ``:`` as
``\\c`` and a line end as ``\\n``), so that no text can hold a mark and
``read_turns`` gives back what was written.

Every example row holds its whole example: ``context``, the text of all turns before
the prompt, ``prompt``, the turns since the example before it, and ``reply``.  The
output therefore grows with the square of a conversation's length, as the method's
examples do; a context is one string, so a conversation has to fit into a task.

Turns are dealt by conversation.  A conversation of more turns than a task's fair
share is cut between turns into *parts* of about such a share, each a group of its own
whose rows have the numbers ``row``, ``example`` and ``context_chars`` inside the
part; ``part_offsets`` has what came before each part.  A part's group also gets the
turns of all parts before it, from which it writes its contexts.

Reading back compares every context with the turns that the rows before it hold.  A
digest over a conversation of several parts has to read it in order; it streams the
rows' prompts and replies and holds one row.

Defined results: a null text or role is empty; rows of one turn number are ordered
by role and then by the XXH64 of their text, null turns come first; a null
conversation id is one conversation; turns after the last reply make a row without
reply (as do prompts of over ``LONG`` characters, which go on in the next row); an
empty table gives no rows; other columns are ignored.  Turn numbers are numeric or
times.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, saved, table

TRAINED = "assistant"
MARK, BETWEEN, END = "### ", ": ", "</turn>\n"
LONG = 1 << 20  # characters of a prompt before it goes on in another row
HELD = 8 << 20  # characters of a conversation up to which contexts are compared as text, beyond by SHA-256
_ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\t"}
_ROLE_ESCAPES = {**_ESCAPES, ":": "\\c", "\n": "\\n"}
_PLAIN = {v[1]: k for k, v in _ROLE_ESCAPES.items()}
_TURN = re.compile(r"### (.*?): (.*?)</turn>\n", re.S)


def escape(text: str, table_: dict[str, str] = _ESCAPES) -> str:
    for plain, written in table_.items():  # the escape character comes first
        text = text.replace(plain, written)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text) if "\\" in text else text


def written_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and start and length of its text in it."""
    head = MARK + escape(role, _ROLE_ESCAPES) + BETWEEN
    body = escape(text)
    return head + body + END, len(head), len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn; the inverse of ``written_turn``."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _batches(rows: Iterator[list], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about 1,000 rows or 4 million characters."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, size = to_arrow_schema(schema), [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= 1000 or size > 4 << 20:
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in held], arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in held], arrow)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


_EXAMPLE = [("part", "int"), ("whole", "boolean"), ("row", "long"), ("example", "long"), ("context_chars", "long"),
            ("context", "string"), ("prompt", "string"), ("reply", "string"), ("loss_start", "long"),
            ("loss_chars", "long")]


def _in_parts(turns: DataFrame, parts: int) -> DataFrame:
    """``turns`` with ``part``, ``target`` and ``whole``: a turn comes once for its own
    part and once for each later part of its conversation.  ``whole``: the
    conversation is one part."""
    sizes = saved(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversation-sizes")
    total, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    share = max(1, -(-total // parts))
    if most <= share:
        return turns.select("*", F.lit(0).alias("part"), F.lit(0).alias("target"), F.lit(True).alias("whole"))
    cuts = -(-most // share)
    large = sizes.where(F.col("n") > share)  # fewer than `parts`
    of_large = turns.join(F.broadcast(large.select(F.col("conv_id").alias("large"))),
                          F.col("conv_id").eqNullSafe(F.col("large")))
    bounds = of_large.groupBy("large").agg(F.array_distinct(F.percentile_approx(
        "turn", [i / cuts for i in range(1, cuts)], 10_000)).alias("bounds"))
    bounds = F.broadcast(saved(bounds, "part-bounds"))
    parted = turns.join(bounds, F.col("conv_id").eqNullSafe(F.col("large")) & F.col("bounds").isNotNull(), "left")
    before = F.size(F.filter("bounds", lambda b: b < F.col("turn")))
    last = F.when(F.col("bounds").isNull(), 0).otherwise(F.size("bounds"))
    return parted.select(*turns.columns, F.when(F.col("bounds").isNull(), 0).otherwise(before).alias("part"),
                         last.alias("last")) \
        .select(*turns.columns, "part", F.explode(F.sequence("part", "last")).alias("target"),
                (F.col("last") == 0).alias("whole"))


def prefix_targets(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """The example rows: conv_id, part, whole (the conversation has no other part),
    row (the order inside a part), example, context_chars, context (all turns of the
    conversation before the prompt), prompt, reply, loss_start and loss_chars (the
    trainable span in prompt + reply, in code points; null without reply).

    Rows of a partition come in the order of conversations, parts and rows."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "target", "turn", "role", "tie"]
    picked = turns.select(col(conv_col).alias("conv_id"), col(turn_col).alias("turn"),
                          F.coalesce(col(role_col), F.lit("")).alias("role"), F.xxhash64(col(text_col)).alias("tie"),
                          F.coalesce(col(text_col), F.lit("")).alias("text"))
    dealt = _in_parts(picked, parts).repartition(parts, "conv_id", "target").sortWithinPartitions(*order).select(
        "conv_id", "target", "part", "whole", "role", "text")
    schema = T.StructType([dealt.schema["conv_id"], *T._parse_datatype_string(
        ", ".join(f"{n} {t}" for n, t in _EXAMPLE)).fields])

    def rows(values: Iterator[tuple]) -> Iterator[list]:
        now, whole_, earlier, context, prompt, size, row, example, chars = None, True, [], "", [], 0, 0, 0, 0

        def closed(reply=None, loss=(None, None)):
            nonlocal context, earlier, prompt, size, row, chars
            if earlier:
                context, earlier = "".join(earlier), []
            asked = "".join(prompt)
            out = [*now, whole_, row, example, chars + size, context, asked, reply, *loss]
            added = asked + (reply or "")
            context, chars, prompt, size, row = context + added, chars + len(added), [], 0, row + 1
            return out

        for conv, target, part, whole, role, text in values:
            if now != (conv, target):
                if prompt:
                    yield closed()
                now, whole_, earlier, context = (conv, target), whole, [], ""
                prompt, size, row, example, chars = [], 0, 0, 0, 0
            turn, start, n = written_turn(role, text)
            if part < target:
                earlier.append(turn)
            elif role == TRAINED:
                yield closed(turn, (size + start, n))
                example += 1
            else:
                prompt.append(turn)
                size += len(turn)
                if size > LONG:
                    yield closed()
        if prompt:
            yield closed()

    return dealt.mapInArrow(lambda b: _batches(rows(_values(b)), schema), schema)


def part_offsets(examples: DataFrame) -> DataFrame:
    """conv_id, part and what the conversation has before that part: rows, examples
    and characters."""
    chars = F.length("prompt") + F.coalesce(F.length("reply"), F.lit(0))
    sizes = examples.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.count("reply").alias("m"),
                                                    F.sum(chars).alias("chars"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("conv_id", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(name) for c, name in
                                             (("n", "rows_before"), ("m", "examples_before"), ("chars", "chars_before"))])


def example_texts(examples: DataFrame) -> DataFrame:
    """conv_id, part, example, context (all turns before the reply) and reply, for a
    trainer that wants whole texts."""
    return examples.where(F.col("reply").isNotNull()).select(
        "conv_id", "part", "example", F.concat("context", "prompt").alias("context"), "reply")


class _Digest:
    """What is read back of one conversation, example row by example row; starts
    behind ``before``, the text of its earlier parts."""

    def __init__(self, before: str = ""):
        self.n_turns = self.loss_chars = self.chars = self.examples = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.before, self.formatted = before, hashlib.sha256(before.encode())  # all turns so far

    def check(self, context: str) -> None:
        if self.before is None:
            same = hashlib.sha256(context.encode()).digest() == self.formatted.digest()
        else:
            same = context == self.before
        if not same:
            raise ValueError("the context of an example differs from the turns before it")

    def add(self, text: str, loss_start: int | None, loss_chars: int | None) -> None:
        for role, said in read_turns(text):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
        if loss_start is not None:
            trained = unescape(text[loss_start:loss_start + loss_chars])
            self.loss.update(trained.encode())
            self.loss_chars += len(trained)
            self.examples += 1
        self.chars += len(text)
        self.formatted.update(text.encode())
        if self.before is not None:
            self.before = self.before + text if len(self.before) + len(text) <= HELD else None

    def row(self) -> list:
        return [self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.examples]


_DIGEST = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "n_examples long")


def read_back(examples: DataFrame) -> DataFrame:
    """One row per conversation, read from its example rows as ``prefix_targets``
    orders them: turns and trainable text as digests, and counts.  Fails if an
    example's context is anything but the turns before it.

    A conversation of one part is read where it lies.  Of the others, contexts are
    compared inside a part; prompts and replies move on by conversation, with the
    hash of each part's first context, and are read in order, one row at a time."""
    id_field = examples.schema["conv_id"]
    place = T._parse_datatype_string(
        "part int, row long, text string, loss_start long, loss_chars_ long, before string").fields
    mid = T.StructType([id_field, *place, *T._parse_datatype_string(_DIGEST).fields])
    none = [None] * 6

    def within(values: Iterator[tuple]) -> Iterator[list]:
        now, digest, whole = None, None, True
        for conv, part, whole_, row, context, prompt, reply, start, n in values:
            first = now != (conv, part)
            if first:
                if digest and whole:
                    yield [now[0], *none, *digest.row()]
                now, whole, digest = (conv, part), whole_, _Digest("" if whole_ else context)
            digest.check(context)
            text = prompt + (reply or "")
            if not whole:
                yield [conv, part, row, text, start, n, digest.formatted.hexdigest() if first else None, *none]
            digest.add(text, start, n)
        if digest and whole:
            yield [now[0], *none, *digest.row()]

    def across(values: Iterator[tuple]) -> Iterator[list]:
        now, digest = None, None
        for conv, _, _, text, start, n, before, *done in values:
            if now != (conv,) and digest:
                yield [now[0], *digest.row()]
                digest = None
            now = (conv,)
            if text is None:
                yield [conv, *done]
                continue
            digest = digest or _Digest()
            if before not in (None, digest.formatted.hexdigest()):
                raise ValueError("the contexts of a part differ from the turns before it")
            digest.before = None  # rows alone, no text is held
            digest.add(text, start, n)
        if digest:
            yield [now[0], *digest.row()]

    read = examples.select("conv_id", "part", "whole", "row", "context", "prompt", "reply", "loss_start", "loss_chars") \
        .mapInArrow(lambda b: _batches(within(_values(b)), mid), mid)
    out = T.StructType([id_field, *T._parse_datatype_string(_DIGEST).fields])
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "part", "row") \
        .mapInArrow(lambda b: _batches(across(_values(b)), out), out)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations and conversation -7, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    return read_back(prefix_targets(turns.unionByName(more)))


OP13_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
written AS (SELECT *,
    length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t'))
    + length(replace(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c'),
                     chr(10), '\n')) + length('### : </turn>') + 1 AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples
FROM written GROUP BY conv_id
"""

QUERIES = {"op13_chat_format": op13_chat_format}
ORACLES = {"op13_chat_format": OP13_SQL}
