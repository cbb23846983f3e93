"""Conversations formatted for training, in windows that end with a turn.

Prefix sums of the turns' tokens decide which window a turn belongs to, so that a
conversation of any length is cut without walking through it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.llm.text import batches
from starweir.llm.tokens import encoder
from starweir.staging import stage

TURN, END = "### ", "</turn>"
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_ROLE = re.compile(r"((?:[^\\:]|\\.)*): ", re.DOTALL)


@dataclass(frozen=True)
class WindowRules:
    #: Tokens of a window. History is left out where it would not fit; a window is longer
    #: only if its own turns and the system turn are.
    budget: int = 2048
    #: A window's own turns begin within so many tokens.
    stride: int = 1024
    #: A turn is repeated in the next window if it has no more tokens than this, and ends
    #: no more than this before that window.
    history: int = 256
    #: Tokens of the template around a turn.
    template: int = 8
    trained: str = "assistant"
    system: str = "system"


def escape(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("###", "\\###").replace(END, "\\" + END)
    return text.replace(":", "\\:") if role else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns, and where each turn's escaped text is in them."""
    parts: list[str] = []
    spans, at = [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role, True)}: ", escape(text)
        parts += [head, body, END, "\n"]
        spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, as they were."""
    turns, at = [], 0
    while at < len(formatted):
        role = _ROLE.match(formatted, at + len(TURN))
        end = start = role.end()
        while True:
            end = formatted.index(END, end)
            before = end
            while before > start and formatted[before - 1] == "\\":
                before -= 1
            if (end - before) % 2 == 0:
                break
            end += 1
        turns.append((unescape(role[1]), unescape(formatted[start:end])))
        at = end + len(END) + 1
    return turns


_TURN_COLUMNS = "block int, conv long, conv_id long, role string, text string"


def _counted(vocabulary: str, rules: WindowRules):
    """Tokens of each turn, and sums over the turns of its conversation in this task."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        block, last, tokens, turns = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches(parts):
            _, bounds = encode(batch.column("text"))
            n = np.diff(bounds) + rules.template
            before, index = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for i, conv in enumerate(batch.column("conv").to_pylist()):
                if conv != last:
                    last, tokens, turns = conv, 0, 0
                before[i], index[i] = tokens, turns
                tokens, turns = tokens + int(n[i]), turns + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(n), pa.int32()),
                    *(batch.column(c) for c in ("conv", "conv_id", "role", "text")),
                    pa.array(n),
                    pa.array(before),
                    pa.array(index),
                ],
                ["block", "conv", "conv_id", "role", "text", "n", "before", "index"],
            )

    return count


def _carried(counted: DataFrame) -> DataFrame:
    """What a task's first conversation had in the tasks before. One row per task."""
    ends = F.struct("conv", (F.col("before") + F.col("n")).alias("tokens"), "index")
    rows = (
        counted.groupBy("block")
        .agg(F.min("conv").alias("first"), F.max(ends).alias("last"))
        .toArrow()
        .sort_by("block")
        .to_pylist()
    )
    carried, conv, tokens, turns = [], None, 0, 0
    for row in rows:
        if row["first"] != conv:
            tokens = turns = 0
        carried.append((row["block"], row["first"], tokens, turns))
        last = row["last"]
        if last["conv"] != row["first"]:
            tokens = turns = 0
        conv, tokens, turns = last["conv"], tokens + last["tokens"], turns + last["index"] + 1
    return counted.sparkSession.createDataFrame(
        carried, "block int, conv long, more_tokens long, more_turns long"
    )


def _assembled(rules: WindowRules):
    def assemble(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in parts:
            out = []
            for row in batch.to_pylist():
                now = row["conv"], row["window"]
                if now != key and held:
                    out.append(window(held))
                    held = []
                key = now
                held.append(row)
            yield rows(out)
        if held:
            yield rows([window(held)])

    def rows(windows: list[dict | None]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([w for w in windows if w], _SCHEMA)

    def window(turns: list[dict]) -> dict | None:
        own = [t for t in turns if t["kind"] == 0]
        if not own:
            return None
        system = [t for t in turns if t["kind"] == 2]
        room = rules.budget - sum(t["n"] for t in own + system)
        past = []
        for turn in reversed([t for t in turns if t["kind"] == 1]):
            room -= turn["n"]
            if room < 0:
                break
            past.append(turn)
        context = system + past[::-1]
        text, spans = format_turns([(t["role"], t["text"]) for t in context + own])
        loss = [
            {"start": s, "end": e}
            for t, (s, e) in zip(own, spans[len(context) :])
            if t["role"] == rules.trained
        ]
        return {
            "conv_id": own[0]["conv_id"],
            "window": own[0]["window"],
            "n_context": len(context),
            "formatted": text,
            "loss": loss,
        }

    return assemble


_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("n_context", pa.int32()),
        ("formatted", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)
WINDOW = """conv_id long, window long, n_context int, formatted string,
    loss array<struct<start:int, end:int>>"""


def format_windows(
    turns: DataFrame, vocabulary: str, rules: WindowRules = WindowRules()
) -> DataFrame:
    """(conv_id, window, n_context, formatted, loss): conversations in windows of turns.

    ``turns`` has conv_id, turn, role and text. A window has whole turns: those that begin
    in its stretch of ``stride`` tokens of the conversation. Before them it repeats the
    conversation's system turn (a first turn of that role) and the last turns of the
    window before, ``n_context`` turns in all. ``loss`` has the spans, in code points, of
    the escaped texts of the window's own trained turns; a repeated turn has none, so
    every text is trained on once. Windows are numbered in order, with gaps where a turn
    is longer than the stride.

    A NULL text or role is empty. A NULL conv_id is one conversation. A NULL turn comes
    first; turns with equal numbers come in the order of a hash. No turns, no windows.
    A conversation with very many turns is spread over tasks, none holds more than a
    window of it.
    """
    ordered = (
        turns.select(
            "conv_id",
            F.coalesce("conv_id", F.lit(-(1 << 63))).alias("conv"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("tie", F.xxhash64("role", "text"))
        .repartitionByRange("conv", "turn", "tie")
        .sortWithinPartitions("conv", "turn", "tie")
        .select("conv", "conv_id", "role", "text")
    )
    counted = stage(
        ordered.mapInArrow(
            _counted(vocabulary, rules), f"{_TURN_COLUMNS}, n long, before long, index long"
        ),
        "turns",
    )
    at = F.col("before") + F.coalesce("more_tokens", F.lit(0))
    end, stride = F.col("before") + F.col("n"), F.lit(rules.stride)
    first, following = F.floor(F.col("before") / stride), F.floor(end / stride)
    placed = (
        counted.join(F.broadcast(_carried(counted)), ["block", "conv"], "left")
        .withColumn("index", F.col("index") + F.coalesce("more_turns", F.lit(0)))
        .withColumn("before", at)
        .withColumn("own", first)
        .withColumn("next", F.when(following > first, following).otherwise(first + 1))
    )
    leads = (F.col("index") == 0) & (F.col("role") == rules.system)
    repeated = (
        (F.col("n") <= rules.history)
        & (end >= F.col("next") * stride - rules.history)
        & ~leads
    )

    def use(window: str, kind: int):
        return F.struct(F.col(window).alias("window"), F.lit(kind).alias("kind"))

    uses = F.when(repeated, F.array(use("own", 0), use("next", 1))).otherwise(
        F.array(use("own", 0))
    )
    columns = ["conv", "conv_id", "window", "kind", "index", "role", "text", "n"]
    used = placed.withColumn("use", F.explode(uses)).select("*", "use.*").select(*columns)
    system = placed.where(leads).select("conv", "role", "text", "n")
    later = used.where("kind = 0 AND window > 0").select("conv", "conv_id", "window").distinct()
    led = later.join(system, "conv").withColumns({"kind": F.lit(2), "index": F.lit(0)})
    return (
        used.unionByName(led.select(*columns))
        .repartition("conv", "window")
        .sortWithinPartitions("conv", "window", "index")
        .mapInArrow(_assembled(rules), WINDOW)
    )


DIGEST = """conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,
    formatted_chars long"""


def read_back(windows: DataFrame) -> DataFrame:
    """What each conversation's windows say when they are parsed again: its turns, in
    order and each once, and the text under the loss mask, as digests.

    Conversations stream through sorted partitions; of one, a window is held at a time.
    """
    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        for batch in parts:
            out = []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != state["conv_id"]:
                    if state is not None:
                        out.append(done(state))
                    state = {
                        "conv_id": row["conv_id"], "n_turns": 0, "turns": hashlib.sha256(),
                        "loss": hashlib.sha256(), "loss_chars": 0, "formatted_chars": 0,
                    }
                text = row["formatted"]
                state["formatted_chars"] += len(text)
                for role, said in parse_turns(text)[row["n_context"] :]:
                    state["n_turns"] += 1
                    state["turns"].update(f"{role}\n{said}\n".encode())
                for span in row["loss"]:
                    said = unescape(text[span["start"] : span["end"]])
                    state["loss_chars"] += len(said)
                    state["loss"].update(said.encode())
            yield rows(out)
        if state is not None:
            yield rows([done(state)])

    def done(state: dict) -> dict:
        return {
            **{k: state[k] for k in ("conv_id", "n_turns", "loss_chars", "formatted_chars")},
            "turns_sha256": state["turns"].hexdigest(),
            "loss_sha256": state["loss"].hexdigest(),
        }

    def rows(found: list[dict]) -> pa.RecordBatch:
        schema = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("n_turns", pa.int64()),
                ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()),
                ("loss_sha256", pa.string()),
                ("formatted_chars", pa.int64()),
            ]
        )
        return pa.RecordBatch.from_pylist(found, schema)

    return (
        windows.repartitionByRange("conv_id")
        .sortWithinPartitions("conv_id", "window")
        .mapInArrow(digest, DIGEST)
    )
