"""Operator 4: chat formatting with spans found by incremental rendering.

The template is a black box: a function from a list of turns (role, text) to
one string.  Successive turn prefixes are rendered; where the output for i + 1
turns starts with the output for i, the rest is turn i's span.  The text inside
the span is found by rendering the same prefix with a probe in place of the
text: what stands before and after the probe must frame the text.  An output
that does not start with its predecessor shows a template that rewrites
history; its spans are then located in the whole output, turn by turn, with the same
probe.

Rendering every prefix is quadratic in the turns, so beyond ``lookback`` turns the
prefixes start ``lookback`` turns back; the joined spans must equal the whole
output, else the whole prefixes are rendered.

Defined cases: rows are ordered by turn, then role, then text (repeated turns
are all kept); null role and null text are empty; rows with a null conv_id form
one conversation; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
PROBE = "probe"
Turn = tuple[str, str]


def escape(text: str) -> str:
    """One more backslash inside every ``<|``-like opening, so none is left bare."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked_template(turns: list[Turn]) -> str:
    return "".join(f"{START}{escape_role(r)}\n{escape(t)}{END}\n" for r, t in turns)


def parse_marked(formatted: str) -> list[Turn]:
    """The turns of an output of ``marked_template``."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, text = part.partition("\n")
        out.append((unescape_role(role), unescape(text[:text.rindex(END)])))
    return out


def _framed(render: Callable[[list[Turn]], str], before: list[Turn], turn: Turn,
            after: list[Turn], whole: str) -> tuple[int, int]:
    """Where the text of ``turn`` stands in ``whole`` = render(before + turn + after)."""
    probed = render([*before, (turn[0], PROBE), *after])
    at = probed.find(PROBE)
    tail = len(probed) - at - len(PROBE)
    a, z = at, len(whole) - tail
    if at < 0 or z < a or whole[:a] != probed[:a] or whole[z:] != probed[at + len(PROBE):]:
        raise ValueError("the template does not keep a turn's text in one piece")
    return a, z


def text_spans(render: Callable[[list[Turn]], str], turns: list[Turn],
               lookback: int = 64) -> tuple[str, list[tuple[int, int]], bool]:
    """The whole output, each turn's text span in it, and whether the template rewrites history."""
    whole = render(turns)

    def incremental(back: int) -> list[tuple[int, int]] | None:
        spans, done = [], 0
        previous, first = render([]), 0
        for i, turn in enumerate(turns):
            begin = max(0, i - back)
            if begin != first:
                previous, first = render(turns[begin:i]), begin
            now = render(turns[begin:i + 1])
            if not now.startswith(previous):
                return None
            a, z = _framed(render, turns[begin:i], turn, [], now)
            if a < len(previous) or whole[done:done + len(now) - len(previous)] != now[len(previous):]:
                return None
            spans.append((done + a - len(previous), done + z - len(previous)))
            done += len(now) - len(previous)
            previous = now
        return spans if done == len(whole) else None

    spans = incremental(lookback)
    if spans is None and len(turns) > lookback:
        spans = incremental(len(turns))
    if spans is not None:
        return whole, spans, False
    return whole, [_framed(render, turns[:i], t, turns[i + 1:], whole)
                   for i, t in enumerate(turns)], True


FORMATTED = ("conv_id bigint, formatted string, loss_spans array<struct<a:bigint,z:bigint>>, "
             "rewrites_history boolean")


def format_conversations(conversations: DataFrame,
                         render: Callable[[list[Turn]], str] = marked_template,
                         loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans (code points of the ``loss_role`` texts, end
    exclusive), rewrites_history; one row per conversation."""
    kinds = pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())]))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    grouped = (conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(
        F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                conv, roles, texts = (b.column(c)[k].as_py() for c in range(3))
                whole, spans, rewrites = text_spans(render, list(zip(roles, texts)))
                loss = [{"a": a, "z": z} for r, (a, z) in zip(roles, spans) if r == loss_role]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv], pa.int64()), pa.array([whole], pa.string()),
                     pa.array([loss], kinds), pa.array([rewrites], pa.bool_())],
                    ["conv_id", "formatted", "loss_spans", "rewrites_history"])

    return grouped.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_text (role, newline, text, newline per turn), loss_text
    (unescaped), formatted_chars: read from the formatted strings alone."""
    schema = ("conv_id bigint, n_turns bigint, turns_text string, loss_text string, "
              "formatted_chars bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                turns = parse_marked(r["formatted"])
                loss = "".join(unescape(r["formatted"][s["a"]:s["z"]]) for s in r["loss_spans"])
                rows.append((r["conv_id"], len(turns), "".join(f"{x}\n{t}\n" for x, t in turns),
                             loss, len(r["formatted"])))
            cols = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                ["conv_id", "n_turns", "turns_text", "loss_text", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, schema)
