"""Chat formatting over tables of turns (operator 1).

``format_conversations`` renders every conversation of a table (conv_id, turn,
role, text; one row per turn) with a compiled template and returns its text in
parts with the spans under the loss mask. Turns are dealt out by conversation and
sorted, and templates render as a stream, so a conversation of any length takes
the memory of one part and one turn. ``read_back`` reads conversations formatted
with TEMPLATE from those parts alone.

Defined cases: a null text or role is empty; turns with equal numbers are ordered
by role, then text (nulls first, as null turn numbers); rows without a conv_id
form one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import arrow_types, rows_of, table, to_batches
from quarry.llm.template import BEGIN, END, compile_template, unescape

#: Marks each turn; control strings in roles and texts are escaped, so they can be read back.
TEMPLATE = (
    "{% for t in messages %}### {{ t.role | escape(':') }}: "
    "{% if t.role == 'assistant' %}{% generation %}{{ t.text | escape }}{% endgeneration %}"
    "{% else %}{{ t.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
PART_CHARS = 1 << 16
PARTS = "conv_id bigint, part int, formatted string, loss_spans array<struct<start:bigint,end:bigint>>"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def cut_parts(pieces: Iterator, size: int) -> Iterator[tuple[str, list[dict]]]:
    """Parts of at most ``size`` characters, each with its spans as offsets in the whole text."""
    held: list[str] = []
    n = at = 0  # characters held; offset of the part
    spans: list[dict] = []
    begun = None
    for piece in pieces:
        if piece is BEGIN:
            begun = at + n
        elif piece is END:
            spans.append({"start": begun, "end": at + n})
            begun = None
        else:
            while n + len(piece) > size:
                head, piece = piece[: size - n], piece[size - n :]
                if begun is not None:
                    spans.append({"start": begun, "end": at + size})
                    begun = at + size
                yield "".join([*held, head]), spans
                held, n, at, spans = [], 0, at + size, []
            held.append(piece)
            n += len(piece)
    yield "".join(held), spans


def format_conversations(turns: DataFrame, template: str = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, formatted, loss_spans): the text is the parts' texts in order.

    Spans are offsets (code points) in the whole text, cut at the ends of parts.
    The template's variable ``messages`` yields mappings with role and text.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    spark = turns.sparkSession
    types = arrow_types(spark, PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def parts() -> Iterator[tuple]:
            for conv, own in groupby(rows_of(batches), key=lambda r: r["conv_id"]):
                messages = ({"role": r["role"] or "", "text": r["text"] or ""} for r in own)
                for k, (text, spans) in enumerate(cut_parts(render(messages=messages), part_chars)):
                    yield conv, k, text, spans

        yield from to_batches(parts(), ["conv_id", "part", "formatted", "loss_spans"], types, 64)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, PARTS)


class Reader:
    """Reads one conversation formatted with TEMPLATE back, part by part."""

    # A backslash escapes what follows; only unescaped marks count.
    _TURN_END = re.compile(r"\\.|(</turn>\n)", re.DOTALL)
    _ROLE_END = re.compile(r"\\.|(: )", re.DOTALL)
    _HEAD = "### "

    def __init__(self) -> None:
        self.rest = self.loss_rest = ""
        self.at = self.n_turns = self.loss_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    @staticmethod
    def _find(mark: re.Pattern, text: str, at: int) -> re.Match | None:
        return next((m for m in mark.finditer(text, at) if m[1]), None)

    def feed(self, formatted: str, spans: list[dict]) -> None:
        for s in spans:
            self._masked(formatted[s["start"] - self.at : s["end"] - self.at])
        self.at += len(formatted)
        text, at = self.rest + formatted, 0
        while end := self._find(self._TURN_END, text, at):
            colon = self._find(self._ROLE_END, text, at)
            if not text.startswith(self._HEAD, at) or not colon or colon.end() > end.start():
                raise ValueError("not a formatted conversation")
            role = unescape(text[at + len(self._HEAD) : colon.start()])
            said = unescape(text[colon.end() : end.start()])
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
            at = end.end()
        self.rest = text[at:]

    def _masked(self, text: str) -> None:
        text = self.loss_rest + text
        slashes = len(text) - len(text.rstrip("\\"))
        keep = len(text) - slashes % 2  # an escape may be cut in two by the end of a part
        self.loss_rest, text = text[keep:], unescape(text[:keep])
        self.loss_chars += len(text)
        self.loss.update(text.encode())

    def result(self) -> tuple:
        if self.rest or self.loss_rest:
            raise ValueError("a formatted conversation ends within a turn")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.at


def read_back(parts: DataFrame) -> DataFrame:
    """One row of digests per conversation, from ``format_conversations``' own partitions."""
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    types = arrow_types(parts.sparkSession, DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for conv, own in groupby(rows_of(batches), key=lambda r: r["conv_id"]):
                reader = Reader()
                for r in own:
                    reader.feed(r["formatted"], r["loss_spans"])
                yield conv, *reader.result()

        yield from to_batches(digests(), names, types)

    return parts.mapInArrow(run, DIGESTS)


#: A conversation whose texts hold the template's own control strings.
TRICKY = [(-7, k, role, "\\### Assistant: </turn> ok") for k, role in enumerate(["user", "assistant"])]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(TRICKY, "conv_id bigint, turn bigint, role string, text string")
    return read_back(format_conversations(turns.unionByName(tricky)))


OP1_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as k
  from (select conv_id, turn, role, text from conversations
        union all select -7, 0, 'user', '\### Assistant: </turn> ok'
        union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
), e as (
  select *, length(replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:'))
          + length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')) + 14 as chars
  from c
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars
from e group by conv_id
"""
