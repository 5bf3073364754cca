r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns up to and including it, as
one text, with a loss span that covers that reply only. Turns that follow the
last reply of a conversation form one further record without a target, so the
output holds every turn.

Template: ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts a
backslash becomes ``\\`` and ``<|`` becomes ``<\|``; inside roles a line feed
becomes ``\n``. No control string can then occur in a text, and
:func:`unescape` restores it.

Rows are dealt by conversation, sorted by turn and streamed; a task holds one
conversation's prefix at a time. The output of a conversation of n turns is of
order n squared by definition of the method.

Defined cases: a null text or role is empty; null turns come first; ties in
turn are ordered by role and text, repeated rows are separate turns; a null
conversation id is one conversation; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from scriptmill.runtime import Workspace, ship

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.S)
FLUSH = 4 << 20  # characters in an output batch


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def turn_text(role: str, text: str) -> tuple[str, str]:
    """The formatted turn up to the text, and the text, both escaped."""
    return f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n", escape(text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a formatted text, unescaped."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, text = part.partition("\n")
        turns.append((unescape(role), unescape(text[: text.rindex(END)])))
    return turns


class _Rows:
    """Column lists that become record batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, *row, size: int = 100) -> bool:
        self.rows.append(row)
        self.size += size
        return self.size >= FLUSH

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), self.schema.types, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0
        return out


def expand(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, example, target_turns, text, loss_start, loss_end): one row a reply, and one without a target for turns after the last reply; offsets are code points."""
    ship(df.sparkSession)
    schema = StructType([df.schema[conv], *StructType.fromDDL("example long, n_turns long, text string, loss_start long, loss_end long").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        out, here, prefix, example, n, open_ = _Rows(arrow), None, [], 0, 0, False
        length = 0

        def rest():
            if open_:
                out.add(here[0], example, n, "".join(prefix), 0, 0, size=length)

        for b in batches:
            for c, r, t in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if here != (c,):
                    rest()
                    here, prefix, example, n, length, open_ = (c,), [], 0, 0, 0, False
                head, body = turn_text(r or "", t or "")
                start, n = length + len(head), n + 1
                prefix += [head, body, END, "\n"]
                length = start + len(body) + len(END) + 1
                if open_ := r != ASSISTANT:
                    continue
                prefix = ["".join(prefix)]
                if out.add(c, example, n, prefix[0], start, start + len(body), size=length):
                    yield out.batch()
                example += 1
        rest()
        if out.rows:
            yield out.batch()

    rows = df.repartition(F.col(conv)).sortWithinPartitions(conv, turn, role, text).select(conv, role, text)
    return rows.mapInArrow(run, schema)


def digests(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the formatted output says of each conversation: its turns, the text under the loss masks, its size."""
    ship(examples.sparkSession)
    schema = StructType([examples.schema[conv], *StructType.fromDDL("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        out, here, loss, loss_chars, chars, last = _Rows(arrow), None, None, 0, 0, ""

        def done():
            turns, h = parse(last), hashlib.sha256()
            for r, t in turns:
                h.update(f"{r}\n{t}\n".encode())
            return out.add(here[0], len(turns), h.hexdigest(), loss_chars, loss.hexdigest(), chars)

        for b in batches:
            for c, target, full, size in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if here != (c,):
                    if here and done():
                        yield out.batch()
                    here, loss, loss_chars, chars = (c,), hashlib.sha256(), 0, 0
                target = unescape(target)
                loss.update(target.encode())
                loss_chars, chars, last = loss_chars + len(target), chars + size, full or ""
        if here:
            done()
        if out.rows:
            yield out.batch()

    # only a conversation's last record holds all its turns; of the others the target is enough
    with_last = examples.groupBy(F.col(conv).alias("_conv")).agg(F.max("example").alias("_last"))
    parts = examples.join(with_last, F.col(conv).eqNullSafe(F.col("_conv"))).select(
        conv, "example",
        F.substring(F.col("text"), F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")).alias("_target"),
        F.when(F.col("example") == F.col("_last"), F.col("text")).alias("_full"), F.length("text").cast("long").alias("_size"),
    )
    return parts.repartition(F.col(conv)).sortWithinPartitions(conv, "example").select(conv, "_target", "_full", "_size").mapInArrow(run, schema)


def format_and_read_back(df: DataFrame) -> DataFrame:
    """Write the examples as a table in the shared folder and digest what is read from it."""
    ws = Workspace(df.sparkSession, "chat")
    return digests(ws.save(expand(df), "examples"))


def op10_sql(control: list[tuple]) -> str:
    """DuckDB: lengths of formatted turns summed over prefixes, digests over ordered texts. ``control``: rows added to the table."""
    rows = ", ".join(f"({c}, {n}, '{r}', '{t}')" for c, n, r, t in control)
    escaped = "replace(replace({0}, '\\', '\\\\'), '<|', '<\\|')"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES {rows}) v(conv_id, turn, role, text))),
l AS (SELECT *, length({escaped.format("text")}) + length(replace({escaped.format("role")}, chr(10), '\\n')) + {len(START) + len(END) + 2} AS size FROM c),
p AS (SELECT *, sum(size) OVER w AS prefix, lead(role) OVER w IS NULL AS final FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{ASSISTANT}'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{ASSISTANT}'), '')) AS loss_sha256,
  (sum(prefix) FILTER (role = '{ASSISTANT}' OR final))::BIGINT AS formatted_chars
FROM p GROUP BY conv_id"""
