"""Chat formatting: offset-aligned masks.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of the
turns that bear loss are intersected with the spans of the tokens by binary search. A
token that reaches over the edge of a span bears loss only within it.

Template: ``<s>`` begins a conversation; ``[INST] text [/INST]`` is a user's turn,
``[SYS] text [/SYS]`` the system's, `` text</s>`` the assistant's and
``[ROLE]name[/ROLE] text</s>`` one of any other role. A control string inside a text gets
a backslash behind its first character, one more if it has some already, so reading takes
off exactly what writing put on.

Turns go by the hash of the conversation and are sorted by turn within the task, so a
task holds one conversation at a time.

Defined results: turns stand in order of turn (null first), role and text; a null role or
text is empty; rows with a null conversation form one. Repeated rows are turns of their
own. An empty table gives no row. Other columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, read

CONTROL = r"/?s>|/?(?:INST|SYS|ROLE)\]"
_WRITE = re.compile(rf"([<\[])(\\*)({CONTROL})")
_READ = re.compile(rf"([<\[])\\(\\*)({CONTROL})")
_MARK = re.compile(r"</?s>|\[/?(?:INST|SYS|ROLE)\]")
LOSS_ROLES = ("assistant",)
FLUSH = 256  # conversations to an output batch

FORMATTED = (
    "n_turns long, formatted string, ids array<int>, offsets array<struct<start:int,end:int>>, loss_mask array<boolean>,"
    " loss_spans array<struct<start:int,end:int>>"
)


def escape(text: str) -> str:
    return _WRITE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _READ.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]], loss_roles=LOSS_ROLES) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of the texts that bear loss, in order."""
    parts, spans, at = ["<s>"], [], 3
    for role, text in turns:
        body = escape(text)
        if role == "user":
            before, after = "[INST] ", " [/INST]"
        elif role == "system":
            before, after = "[SYS] ", " [/SYS]"
        elif role == "assistant":
            before, after = " ", "</s>"
        else:
            before, after = f"[ROLE]{escape(role)}[/ROLE] ", "</s>"
        if role in loss_roles:
            spans.append((at + len(before), at + len(before) + len(body)))
        parts += [before, body, after]
        at += len(before) + len(body) + len(after)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    marks = list(_MARK.finditer(formatted))
    turns, i = [], 1  # the first mark begins the conversation
    while i < len(marks):
        m = marks[i]
        if m.group() in ("[INST]", "[SYS]"):
            turns.append(("user" if m.group() == "[INST]" else "system", formatted[m.end() + 1 : marks[i + 1].start() - 1]))
            i += 2
        elif m.group() == "[ROLE]":
            name, close = formatted[m.end() : marks[i + 1].start()], marks[i + 2]
            turns.append((unescape(name), formatted[marks[i + 1].end() + 1 : close.start()]))
            i += 3
        else:
            turns.append(("assistant", formatted[marks[i - 1].end() + 1 : m.start()]))
            i += 1
    return [(role, unescape(text)) for role, text in turns]


def align(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The tokens that touch a span, and the parts of the spans they cover, joined within a span."""
    if not spans or not len(offsets):
        return np.zeros(len(offsets), bool), []
    begin, end = np.array(spans).T
    first = np.searchsorted(end, offsets[:, 0], "right")
    last = np.searchsorted(begin, offsets[:, 1], "left")
    mask = first < last
    covered: dict[int, list[int]] = {}
    for (lo, hi), a, b in zip(offsets[mask].tolist(), first[mask].tolist(), last[mask].tolist()):
        for k in range(a, b):
            lo_k, hi_k = max(lo, spans[k][0]), min(hi, spans[k][1])
            if hi_k > lo_k:
                part = covered.setdefault(k, [lo_k, hi_k])
                part[1] = max(part[1], hi_k)
    return mask, [(a, b) for _, (a, b) in sorted(covered.items())]


def conversations_of(batches) -> Iterator[tuple]:
    """(key, turns) of each conversation of a sorted stream of (key, role, text)."""
    key, turns, begun = None, [], False
    for batch in batches:
        for k, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if begun and k != key:
                yield key, turns
                turns = []
            key, begun = k, True
            turns.append((role or "", text or ""))
    if begun:
        yield key, turns


def format_chats(rows: DataFrame, tokenizer: str, key: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_roles=LOSS_ROLES) -> DataFrame:
    """``key`` with the formatted text, ids, offsets, loss mask and loss spans of each conversation.

    ``tokenizer``: path of a byte-level vocabulary file on every executor.
    """

    def run(batches):
        from tokenizers import Tokenizer, processors

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True  # their strings in a text are ordinary text
        encoder.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets with the blanks
        kind, out = None, []

        def first_kind(it):
            nonlocal kind
            for b in it:
                kind = kind or b.column(0).type
                yield b

        def batch_of(found):
            texts = [x[1] for x in found]
            rows = []
            for (k, rendered, n, spans), e in zip(found, encoder.encode_batch(texts, add_special_tokens=False)):
                offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
                mask, covered = align(offsets, spans)
                pairs = [{"start": a, "end": b} for a, b in e.offsets]
                rows.append((k, n, rendered, e.ids, pairs, mask.tolist(), [{"start": a, "end": b} for a, b in covered]))
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            types = [kind, pa.int64(), pa.string(), pa.list_(pa.int32()), span, pa.list_(pa.bool_()), span]
            names = [key, "n_turns", "formatted", "ids", "offsets", "loss_mask", "loss_spans"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for k, turns in conversations_of(first_kind(batches)):
            rendered, spans = render(turns, loss_roles)
            out.append((k, rendered, len(turns), spans))
            if len(out) >= FLUSH:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    c = lambda n: column(rows, n)
    ordered = rows.select(c(key), c(turn), c(role), c(text)).repartition(c(key)).sortWithinPartitions(c(key), c(turn), c(role), c(text))
    plain = ordered.select(c(key), c(role), c(text))
    return plain.mapInArrow(run, f"`{key}` {plain.schema[0].dataType.simpleString()}, {FORMATTED}")


def digests(chats: DataFrame, key: str = "conv_id") -> DataFrame:
    """What a reader finds in the formatted conversations, as digests."""

    def run(batches):
        import hashlib

        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            out = []
            for k, formatted, spans, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                turns = parse(formatted)
                loss = "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
                out.append((k, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(formatted), len(ids)))
            types = [batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
            cols = zip(*out) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)

    plain = chats.select(key, "formatted", "loss_spans", "ids")
    kind = plain.schema[0].dataType.simpleString()
    return plain.mapInArrow(
        run, f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    )


def op1_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chats(rows, public_tokenizers.path("byte_bpe_50k.json"))
    return digests(chats).drop("n_tokens")
