"""Operator 5, chat formatting: minimum-cost repair of the role sequence, then rendering.

Legal sequences: an optional system turn, then user and assistant in turn, starting with user and ending
with either.  A dynamic program over the automaton's states (start, system, user, assistant) gives every
turn its final role at least total cost: keeping is free; merging a turn into the one before it,
inserting an empty turn and giving a turn another role cost ``MERGE``, ``INSERT`` and ``RELABEL``
(``NAME`` for a role that no name is known for).  Ties prefer the earlier state in the order above.

A turn's step is a small table of costs from state to state, and such tables compose, so a long
conversation is cut into chunks of ``CHUNK`` turn numbers.  Blocks of chunks are composed in one pass,
the few tables of each conversation decide every chunk's first and last state, and a second pass
over the same exchange repairs and renders each chunk.  No conversation has to fit in one task.

Output: one row a turn with its final role, the action (keep, merge, relabel, insert: several joined
by '+'), the empty roles inserted before it, and the rendered fragment; a conversation's fragments in
order are its rendered sequence.

Defined results.  Turns are ordered by turn number (null last), then role, then text; rows alike in all
three are all kept (equal roles merge).  A null role is unknown; a null text is empty.  A row without
conversation id is a conversation of its own.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.llm import blocks as B

# States, known names of roles, costs, and markers of the rendered form.
STATES = ["start", "system", "user", "assistant"]
NAMES = {"system": 1, "developer": 1, "user": 2, "human": 2, "prompter": 2, "assistant": 3, "gpt": 3, "bot": 3, "model": 3}
FOLLOWS = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
MERGE, INSERT, RELABEL, NAME = 1, 2, 3, 1
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

CHUNK = 1024
FAR = 1 << 40
SCHEMA = "conv_id long, turn long, place int, role string, action string, inserted array<string>, rendered string"


def _moves() -> tuple[np.ndarray, list]:
    """Cost from state to final role without relabelling, and the inserted roles of each move."""
    cost, put = np.full((4, 4), FAR), [[() for _ in range(4)] for _ in range(4)]
    for s in range(4):
        for r in (1, 2, 3):
            if r in FOLLOWS[s]:
                cost[s, r] = 0
            elif s == r:
                cost[s, r] = MERGE
            else:
                for x in FOLLOWS[s]:
                    if r in FOLLOWS[x]:
                        cost[s, r], put[s][r] = INSERT, (x,)
                        break
    return cost, put


MOVES, INSERTED = _moves()


def known(role: str | None) -> int:
    """The state a role's name stands for; 0 if unknown."""
    return NAMES.get((role or "").strip().lower(), 0)


def steps() -> list[np.ndarray]:
    """The cost table of a turn for each known role (0: unknown)."""
    out = []
    for given in range(4):
        price = np.array([0 if given == r else (RELABEL if given else NAME) for r in range(4)])
        out.append(np.minimum(MOVES + price, FAR))
    return out


STEPS = steps()


def composed(given: list[int]) -> np.ndarray:
    """The cost table of a whole sequence of roles."""
    table = np.full((4, 4), FAR)
    np.fill_diagonal(table, 0)
    for g in given:
        table = np.minimum((table[:, :, None] + STEPS[g][None]).min(1), FAR)
    return table


def path(given: list[int], entry: int, exit_: int) -> list[int]:
    """Final roles of the cheapest way from state ``entry`` to state ``exit_``."""
    costs = [np.where(np.arange(4) == entry, 0, FAR)]
    for g in given:
        costs.append(np.minimum((costs[-1][:, None] + STEPS[g]).min(0), FAR))
    out, at = [], exit_
    for i in range(len(given) - 1, -1, -1):
        out.append(at)
        at = int(np.argmin(costs[i] + STEPS[given[i]][:, at]))
    return out[::-1]


def joints(tables: list[np.ndarray]) -> list[int]:
    """States before, between and after chunks on the cheapest way from start to a legal end."""
    costs = [np.array([0, FAR, FAR, FAR])]
    for t in tables:
        costs.append(np.minimum((costs[-1][:, None] + t).min(0), FAR))
    at = 2 + int(np.argmin(costs[-1][2:]))  # user or assistant
    if costs[-1][at] >= FAR:  # only system turns
        at = int(np.argmin(costs[-1]))
    out = [at]
    for t, before in zip(reversed(tables), reversed(costs[:-1])):
        out.append(int(np.argmin(before + t[:, out[-1]])))
    return out[::-1]


_TABLE = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("block", pa.int32()), ("costs", pa.list_(pa.int64()))])
_ENDS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("block", pa.int32()), ("entry", pa.int32()),
                   ("exit", pa.int32()), ("last", pa.bool_())])
_OUT = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.int32()), ("role", pa.string()), ("action", pa.string()),
                  ("inserted", pa.list_(pa.string())), ("rendered", pa.string())])


def _chunks(rows: pa.Table) -> list[tuple[tuple, list[dict]]]:
    """The block's chunks, each a key and its turns in order."""
    by: dict[tuple, list] = {}
    for r in rows.to_pylist():
        by.setdefault((r["conv_id"], r["chunk"]), []).append(r)
    for turns in by.values():
        turns.sort(key=lambda r: (r["turn"] is None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    return list(by.items())


def _render(turns: list[dict], roles: list[int], entry: int, last: bool, out: dict) -> None:
    before = entry
    for i, (turn, role) in enumerate(zip(turns, roles)):
        given = known(turn["role"])
        merged = before == role
        put = INSERTED[before][role]
        actions = [name for name, on in (("relabel", given != role), ("merge", merged), ("insert", bool(put))) if on]
        text = (turn["text"] or "").replace(OPEN, "<| im_start|>").replace(CLOSE.strip(), "<| im_end|>")
        head = "\n\n" if merged else (CLOSE if before else "") + "".join(f"{OPEN}{STATES[x]}\n{CLOSE}" for x in put) + f"{OPEN}{STATES[role]}\n"
        tail = CLOSE if last and i == len(turns) - 1 else ""
        for name, v in zip(_OUT.names, (turn["conv_id"], turn["turn"], i, STATES[role], "+".join(actions) or "keep",
                                        [STATES[x] for x in put], head + text + tail)):
            out[name].append(v)
        before = role


def repair(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, turn, place (in its chunk of turn numbers), role, action, inserted, rendered for every row."""
    n = B.partitions(conversations.sparkSession)
    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    # rows without an id are alone; their chunk number only spreads them
    chunk = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")) \
        .otherwise(F.coalesce(F.expr(f"turn div {CHUNK}"), F.lit((1 << 63) - 1)))
    rows = rows.withColumn("chunk", chunk.cast("long")) \
        .withColumn("block", F.pmod(F.xxhash64("conv_id", "chunk"), F.lit(n * B.BLOCKS_A_PARTITION)).cast("int")).repartition(n, "block")

    def compose(block_rows: pa.Table) -> pa.Table:
        out = {name: [] for name in _TABLE.names}
        for (conv, chunk_), turns in _chunks(block_rows):
            if conv is not None:
                costs = composed([known(t["role"]) for t in turns]).ravel().tolist()
                for name, v in zip(_TABLE.names, (conv, chunk_, turns[0]["block"], costs)):
                    out[name].append(v)
        return B.table(out, _TABLE)

    def decide(tables: pa.Table) -> pa.Table:
        by: dict[int, list] = {}
        for r in tables.to_pylist():
            by.setdefault(r["conv_id"], []).append(r)
        out = {name: [] for name in _ENDS.names}
        for conv, parts in by.items():
            parts.sort(key=lambda r: r["chunk"])
            states = joints([np.array(r["costs"]).reshape(4, 4) for r in parts])
            for i, r in enumerate(parts):
                for name, v in zip(_ENDS.names, (conv, r["chunk"], r["block"], states[i], states[i + 1], i == len(parts) - 1)):
                    out[name].append(v)
        return B.table(out, _ENDS)

    def render(block_rows: pa.Table, ends: pa.Table) -> pa.Table:
        found = {(r["conv_id"], r["chunk"]): r for r in ends.to_pylist()}
        out = {name: [] for name in _OUT.names}
        for key, turns in _chunks(block_rows):
            if key[0] is None:
                for t in turns:
                    given = [known(t["role"])]
                    _render([t], path(given, 0, joints([composed(given)])[1]), 0, True, out)
            else:
                e = found[key]
                _render(turns, path([known(t["role"]) for t in turns], e["entry"], e["exit"]), e["entry"], e["last"], out)
        return B.table(out, _OUT)

    tables = B.on_blocks(rows, None, compose, "conv_id long, chunk long, block int, costs array<long>")
    ends = tables.withColumn("bucket", F.pmod(F.xxhash64("conv_id"), F.lit(n))).groupBy("bucket") \
        .applyInArrow(lambda t: decide(t.drop_columns(["bucket"])), "conv_id long, chunk long, block int, entry int, exit int, last boolean")
    return B.on_blocks(rows, ends, render, SCHEMA)
