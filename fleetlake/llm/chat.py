"""Chat formatting by incremental rendering of a template that is only ever called, never read.

A template is a function from a list of ``(role, text)`` to a string. It is called for each prefix
of a conversation; what a call adds to the one before is the new turn's span. A second call with a
probe character in place of the turn's text tells where in the span the text stands. A template
whose output for a prefix is not a prefix of the next output rewrites its history; such turns are
reported, and the texts are then located by probes in the whole conversation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepared

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

#: Strings that chat templates use for control. Fixed values.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
#: Probes are two characters of the private use area.
_PROBES = [chr(c) for c in range(0xE000, 0xF900)]
_PRIVATE = re.compile("[\ue000-\uf8ff](?=(.))", re.DOTALL)

FORMATTED = (
    "conv_id long, formatted string, loss_spans array<struct<start:int,end:int>>, "
    "turn_spans array<struct<start:int,end:int>>, rewritten array<int>"
)


def escape(text: str) -> str:
    """Double every backslash, and put one behind the first character of every control string."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def chatml(turns: Turns) -> str:
    """The default template: start mark, role, line feed, text, end mark, line feed."""
    return "".join(
        f"<|im_start|>{escape(role).replace(chr(10), chr(92) + chr(10))}\n{escape(text)}<|im_end|>\n"
        for role, text in turns
    )


def parse(formatted: str) -> Turns:
    """The turns of a :func:`chatml` output; raises ValueError for any other string."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def _probed(template: Template, before: Turns, turn: tuple[str, str], after: Turns, output: str, probe: str):
    """Start and end of the turn's text in ``output``, or None if it can't be told."""
    with_probe = template([*before, (turn[0], probe), *after])
    if with_probe.count(probe) != 1:
        return None
    head, tail = with_probe.split(probe)
    if len(head) + len(tail) > len(output) or not (output.startswith(head) and output.endswith(tail)):
        return None
    return len(head), len(output) - len(tail)


def _probe(turns: Turns) -> str:
    """Two different characters that stand nowhere side by side; there are more such pairs than a string can hold."""
    used = {m[0] + m[1] for turn in turns for s in turn for m in _PRIVATE.finditer(s)}
    return next(a + b for a in _PROBES for b in _PROBES if a != b and a + b not in used)


def render(template: Template, turns: Turns):
    """``formatted, text spans, turn spans, rewriting turns``; spans that can't be told are None."""
    probe = _probe(turns)
    output, texts, spans, rewriting = "", [], [], []
    for i, turn in enumerate(turns):
        following = template(turns[: i + 1])
        if following.startswith(output):
            spans.append((len(output), len(following)))
            texts.append(_probed(template, turns[:i], turn, [], following, probe))
        else:
            rewriting.append(i)
            spans.append(None)
            texts.append(None)
        output = following
    if rewriting:  # earlier positions no longer hold
        spans = [None] * len(turns)
        texts = [_probed(template, turns[:i], t, turns[i + 1 :], output, probe) for i, t in enumerate(turns)]
    return output, texts, spans, rewriting


def format_chats(conversations: DataFrame, template: Template = chatml, trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans, turn_spans, rewritten``.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are ignored. Rows are put in
    order of turn, then role and text, so that ties and repeated rows have one order; a null turn
    comes first. Null roles and texts are empty. Rows with a null ``conv_id`` form one conversation.
    ``loss_spans`` has the place of every text of the role ``trained`` in ``formatted``, in code
    points; a text that the template doesn't show, or changes beyond recognition, has none.
    ``turn_spans`` is empty and ``rewritten`` names the turns (from 0) that changed earlier output,
    if the template rewrites history.

    A conversation is one string and so is made in one task, in time that grows with the square of
    its turns, as every prefix is rendered.
    """
    prepared(conversations.sparkSession)
    grouped = conversations.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
                )
            )
        ).alias("turns")
    )

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out = []
            for turns in batch.column("turns").to_pylist():
                turns = [(t["role"], t["text"]) for t in turns]
                whole, texts, spans, rewriting = render(template, turns)
                loss = [s for s, (role, _) in zip(texts, turns, strict=True) if role == trained and s]
                as_spans = [[{"start": a, "end": b} for a, b in x] for x in (loss, [s for s in spans if s])]
                out.append((whole, *as_spans, rewriting))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], place),
                    pa.array(columns[2], place),
                    pa.array(columns[3], pa.list_(pa.int32())),
                ],
                ["conv_id", "formatted", "loss_spans", "turn_spans", "rewritten"],
            )

    return grouped.mapInArrow(formatted, FORMATTED)
