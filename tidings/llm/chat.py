"""Roles of chat transcripts, recovered by a hidden Markov model, and canonical turns.

States are a role and whether a line begins a turn or goes on with one. A line shows a symbol made
of its speaker marker, its length, whether it asks, and whether it opens a message. Roles come from the best path
(Viterbi). Paths compose: a chunk of messages is a matrix of best scores between states, so a
conversation of any length is solved chunk by chunk, and no task holds more than a chunk's lines
or a conversation's chunk matrices.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.numbering import numbered
from tidings.llm.tables import stored

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)
#: The state before the first line.
START = STATES
#: Messages of a conversation that are solved together.
CHUNK = 256

#: Names of speakers (fixed values), by role.
NAMES = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "you"),
    "assistant": ("assistant", "ai", "bot", "answer", "model"),
}
_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role]}
_MARKER = re.compile(
    r"\s*(?:\[(?P<a>[A-Za-z]{1,20})\]:?|<\|(?P<b>[A-Za-z]{1,20})\|>|\*\*(?P<c>[A-Za-z]{1,20}):?\*\*:?|(?:#{1,4}\s*)?(?P<d>[A-Za-z]{1,20}):)(?:\s+|$)"
)
SYMBOLS = 5 * 4 * 2 * 2


def split_marker(line: str) -> tuple[int, str]:
    """The speaker that a line names (-1: none, 0 to 2: a role, 3: someone else), and the rest."""
    found = _MARKER.match(line)
    if not found:
        return -1, line
    role = _ROLE_OF.get(next(x for x in found.groups() if x).lower(), 3)
    return role, line if role == 3 else line[found.end() :]


def line_symbols(text: str | None) -> list[int]:
    """The symbol of each line of a message."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        marker, body = split_marker(line)
        size = 0 if not body.strip() else 1 if len(body) < 60 else 2 if len(body) < 240 else 3
        out.append((((marker + 1) * 4 + size) * 2 + body.rstrip().endswith("?")) * 2 + (i == 0))
    return out


@dataclass(frozen=True)
class Chain:
    """Log probabilities between states, START included, and of symbols by state."""

    step: np.ndarray
    show: np.ndarray


def with_symbols(messages: DataFrame) -> DataFrame:
    """``messages`` with ``symbols``, those of the lines of ``text``."""
    kept = [f for f in messages.schema if f.name != "symbols"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = [line_symbols(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(symbols, pa.list_(pa.int32()))], [*batch.schema.names, "symbols"])

    form = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", symbols array<int>"
    return messages.select(*[f.name for f in kept]).mapInArrow(run, form)


def fit_chain(labelled: DataFrame) -> Chain:
    """A chain from messages (conv_id, turn, role, text) whose roles are known: smoothed counts.

    Messages with other roles or without ids teach nothing. Only counts by state, of a fixed
    number, reach the driver. Without messages every path is as good as any other.
    """
    known = with_symbols(labelled.select("conv_id", "turn", "role", "text")).select(
        "conv_id", "turn", (2 * (F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1)).cast("int").alias("state"), "symbols"
    )
    known = stored(known.where("state >= 0 and conv_id is not null and turn is not null"), "messages")
    lines = known.select(F.posexplode("symbols").alias("line", "symbol"), "state")
    inner = F.when(F.col("line") > 0, F.col("state") + 1).otherwise(F.col("state"))
    shown = lines.groupBy(inner.alias("a"), F.col("symbol").alias("b")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("show").alias("kind"), "*")
    size = F.size("symbols")
    within = known.groupBy("state").agg(
        F.sum((size > 1).cast("long")).alias("first"), F.sum(F.greatest(size - 2, F.lit(0))).alias("more")
    )
    begun = within.select(F.lit("step").alias("kind"), F.col("state").alias("a"), (F.col("state") + 1).alias("b"), F.col("first").alias("n"))
    held = within.select(F.lit("step").alias("kind"), (F.col("state") + 1).alias("a"), (F.col("state") + 1).alias("b"), F.col("more").alias("n"))
    last = F.when(size > 1, F.col("state") + 1).otherwise(F.col("state"))
    ended = known.select("conv_id", (F.col("turn") + 1).alias("turn"), last.alias("a"))
    after = known.select("conv_id", "turn", F.col("state").alias("b")).join(ended, ["conv_id", "turn"], "left")
    turned = after.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    turned = turned.select(F.lit("step").alias("kind"), F.coalesce("a", F.lit(START)).alias("a"), "b", "n")
    step, show = np.full((STATES + 1, STATES), 0.1), np.full((STATES, SYMBOLS), 0.1)
    for r in shown.unionByName(begun).unionByName(held).unionByName(turned).collect():
        (show if r["kind"] == "show" else step)[r["a"], r["b"]] += r["n"] or 0
    step = np.log(step / step.sum(axis=1, keepdims=True))
    show = np.log(show / show.sum(axis=1, keepdims=True))
    never = np.full((STATES + 1, 1), -np.inf)
    return Chain(np.hstack([step, never]), np.vstack([show, np.zeros((1, SYMBOLS))]))


def best_between(chain: Chain, symbols: Iterable[int], best: np.ndarray | None = None) -> np.ndarray | None:
    """Best scores of paths from each state before ``symbols`` to each last state; ``best``: so far."""
    for symbol in symbols:
        one = chain.step + chain.show[:, symbol]
        best = one if best is None else (best[:, :, None] + one[None]).max(axis=1)
    return best


def best_path(chain: Chain, symbols: list[int], before: int = START, last: int | None = None) -> list[int]:
    """The best states of ``symbols`` after state ``before``; they end in ``last`` if that is given."""
    score = chain.step[before] + chain.show[:, symbols[0]]
    back = np.zeros((len(symbols), STATES + 1), np.int8)
    for i, symbol in enumerate(symbols[1:], 1):
        ways = score[:, None] + chain.step
        back[i] = ways.argmax(axis=0)
        score = ways.max(axis=0) + chain.show[:, symbol]
    path = [int(score.argmax()) if last is None else last]
    for i in range(len(symbols) - 1, 0, -1):
        path.append(int(back[i, path[-1]]))
    return path[::-1]


def _groups(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by equal first columns: the key, and its rows as they come."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    yield from groupby(rows(), key=lambda r: r[:n_keys])


def _sorted(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def recover_turns(messages: DataFrame, chain: Chain, chunk: int = CHUNK) -> DataFrame:
    """The turns of each conversation with their recovered roles, in canonical form.

    ``messages`` has conv_id, turn (their order) and text; a role column is not looked at. Columns:
    conv_id, turn (from 0), role, n_lines, text (without markers and outer blank lines), rendered
    (``<|role|>``, the text and ``<|end|>`` on lines of their own). A line belongs to exactly one
    turn; a message may be split or go on with the turn before. A null text is one blank line.
    Messages of one number, also repeated rows, are ordered by a hash of their text. Null conv_ids are one
    conversation; null turns come first.
    """
    ordered = messages.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Chunks are cut by the number of messages: turns may be null, repeated or far apart.
    ordered = numbered(ordered.withColumn("digest", F.xxhash64("text")), ["conv"], ["turn", "digest"], "at")
    ordered = ordered.select("conv", "at", "text", F.floor((F.col("at") - 1) / chunk).alias("chunk"))
    parts = stored(with_symbols(ordered), "messages")
    in_order = _sorted(parts, ["conv", "chunk"], "at")

    def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for (conv, number), rows in _groups(batches, 2):
            best = None
            for row in rows:
                best = best_between(chain, row[2], best)
            found.append((conv, number, best.ravel().tolist()))
            if len(found) >= 4096:
                yield _batch(found, _MATRICES)
                found = []
        yield _batch(found, _MATRICES)

    def borders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for (conv,), rows in _groups(batches, 1):
            numbers, back = [], []
            score = np.full(STATES + 1, -np.inf)
            score[START] = 0.0
            for _, number, best in rows:
                ways = score[:, None] + np.asarray(best).reshape(STATES + 1, STATES + 1)
                numbers.append(number)
                back.append(ways.argmax(axis=0).astype(np.int8))
                score = ways.max(axis=0)
            last = int(score.argmax())
            for number, pointers in zip(numbers[::-1], back[::-1]):
                found.append((conv, number, int(pointers[last]), last))
                last = int(pointers[last])
            if len(found) >= 4096:
                yield _batch(found, _BORDERS)
                found = []
        yield _batch(found, _BORDERS)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for (conv, number), rows in _groups(batches, 2):
            held = list(rows)
            before, last = held[0][4:6]
            lines = [line for row in held for line in row[2].split("\n")]
            states = best_path(chain, [s for row in held for s in row[3]], before, last)
            place = 0
            for own, run in groupby(_turns(states, before)):
                size, role = len([*run]), ROLES[states[place] // 2]
                text = "\n".join(split_marker(line)[1] for line in lines[place : place + size])
                found.append((conv, number, own, place, role, size, text))
                place += size
            if len(found) >= 1024:
                yield _batch(found, _SEGMENTS)
                found = []
        yield _batch(found, _SEGMENTS)

    chunks = in_order.select("conv", "chunk", "symbols").mapInArrow(matrices, _ddl(_MATRICES))
    edges = _sorted(chunks, ["conv"], "chunk").mapInArrow(borders, _ddl(_BORDERS))
    edges = edges.select(F.col("conv").alias("c_conv"), F.col("chunk").alias("c_chunk"), "before", "last")
    joined = parts.join(edges, F.col("conv").eqNullSafe(F.col("c_conv")) & (F.col("chunk") == F.col("c_chunk")))
    joined = joined.select("conv", "chunk", "at", "text", "symbols", "before", "last")
    dealt = _sorted(joined, ["conv", "chunk"], "at").select("conv", "chunk", "text", "symbols", "before", "last")
    segments = stored(dealt.mapInArrow(decode, _ddl(_SEGMENTS)), "segments")
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = segments.groupBy("conv", "chunk").agg(F.max("own").alias("n"))
    counts = counts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    counts = counts.select(F.col("conv").alias("c_conv"), F.col("chunk").alias("c_chunk"), "earlier")
    owned = segments.join(counts, F.col("conv").eqNullSafe(F.col("c_conv")) & (F.col("chunk") == F.col("c_chunk")))
    owned = owned.select(
        "conv", (F.col("earlier") + F.col("own") - 1).alias("turn"), "role", "n_lines", F.struct("chunk", "place", "text").alias("part")
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["text"]), "\n")
    turns = owned.groupBy("conv", "turn").agg(F.first("role").alias("role"), F.sum("n_lines").alias("n_lines"), text.alias("text"))
    body = F.regexp_replace("text", r"^(?:[ \t\r]*\n)+|\s+$", "")
    rendered = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), body, F.lit("\n<|end|>"))
    return turns.select(
        F.col("conv").cast(messages.schema["conv_id"].dataType).alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "n_lines",
        body.alias("text"),
        rendered.alias("rendered"),
    )


_MATRICES = {"conv": "string", "chunk": "long", "best": "array<double>"}
_BORDERS = {"conv": "string", "chunk": "long", "before": "int", "last": "int"}
_SEGMENTS = {"conv": "string", "chunk": "long", "own": "int", "place": "int", "role": "string", "n_lines": "long", "text": "string"}
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<double>": pa.list_(pa.float64())}


def _ddl(form: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in form.items())


def _batch(rows: list[tuple], form: dict[str, str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(form)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, form.values())], [*form])


def _turns(states: list[int], before: int) -> Iterator[int]:
    """For each line the number of its turn in the chunk; 0 goes on with the turn before the chunk.

    A turn begins where the state says so, where the role changes, and at the first line of all.
    """
    own = 0
    for state in states:
        own += before == START or state % 2 == 0 or state // 2 != before // 2
        before = state
        yield own


def hide_roles(conversations: DataFrame) -> DataFrame:
    """Messages as raw transcripts have them: a speaker marker in the style of the conversation in
    front of about three of four messages, nothing in front of the others. The roles stay as a column."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    label = F.initcap("role")
    marker = (
        F.when(style == 0, F.concat(label, F.lit(": ")))
        .when(style == 1, F.concat(F.lit("["), F.col("role"), F.lit("] ")))
        .when(style == 2, F.concat(F.lit("### "), label, F.lit(": ")))
        .otherwise(F.concat(F.lit("<|"), F.col("role"), F.lit("|> ")))
    )
    shown = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) > 0
    named = F.concat(F.when(shown & F.col("role").isNotNull(), marker).otherwise(F.lit("")), F.coalesce("text", F.lit("")))
    return conversations.select("conv_id", "turn", "role", named.alias("text"))
