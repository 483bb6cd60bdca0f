"""Repair of conversation structure: cheapest edits, least audit by prefix-doubling path ranking.

The rows of a conversation, by turn, are edited until the initials of their roles read
`(s?(ua)+)?`: an optional system turn, then user and assistant in turn. An edit keeps a row (K, 0),
gives it the other role (R, 2), deletes it (D, 3) or inserts an empty turn (I, 2). Rows without text
and repeated rows have to be deleted; a row that stays and doesn't end in `.`, `!` or `?` costs 1.

A dynamic program from the last row back gives every node (row, state of the grammar) its cost.
Arcs that keep to that cost are optimal, and the audit of a path is the string of its edits. Nodes are
ranked by their least audits of 1, 2, 4, ... edits: the rank for twice the length is the rank
of the pair (own rank, least rank of the nodes that the first half leads to). A label fixes how many
rows it consumes, so those nodes lie on one row and are a few bits. The ranks choose each node's
arc, and paths are read off doubled pointers. All conversations of a batch are worked on together.

Rows go by turn, nulls first; ties by role, then text, so repeated rows stand side by side. Null
texts and roles are one space. A null conv_id is a conversation of its own. Rows whose `present` is
false only name their conversation, which has a result even if nothing of it is left. Texts of any
length are kept whole; a conversation is held by one worker, as its repaired form is one value.
An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import ship

#: Edits in the order of their initials, and their costs.
EDITS, DELETE, INSERT, KEEP, REROLE = "DIKR", 0, 1, 2, 3
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
CUT_SHORT = 1
#: The grammar: in each state the initials that may follow and the states they lead to.
FOLLOW = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
#: Roles that an edit may put into a conversation, and neighbours that a sound one has.
PUT = ("user", "assistant")
SOUND = {"su", "ua", "au"}
STATES = len(FOLLOW)
#: States that a role put in leads to, with the role.
_PUTS = [[(FOLLOW[s][r[0]], r) for r in PUT if r[0] in FOLLOW[s]] for s in range(STATES)]
ROLE_OF = {to: role for puts in _PUTS for to, role in puts}
#: Rows worked on together, about.
AT_ONCE = 20_000

SOUND_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)


def faults(rows: list[tuple[str, str]]) -> list[int]:
    """The first fault of each (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        if not last:
            out.append(BLANK)
        elif (role, text) in seen:
            out.append(DUPLICATE)
        else:
            out.append(SOUND_FAULT if last in ".!?" else TRUNCATED)
        seen.add((role, text))
    return out


def _insertions(cost: list[int]) -> list[int]:
    """Costs of the states of one row when turns may be inserted before it; each state once at most."""
    for _ in range(STATES):
        cost = [
            min([cost[s], *(COST[INSERT] + cost[to] for to, _ in _PUTS[s])]) for s in range(STATES)
        ]
    return cost


_FAR = 1 << 40
_LAST = [0 if s in FINAL else _FAR for s in range(STATES)]
_AT_END = _insertions(_LAST)


def costs(initials: list[str], fault: list[int]) -> list[list[int]]:
    """For each row, and for the end, the least cost of all that follows, by state."""
    after = _AT_END
    out = [after]
    for initial, what in zip(reversed(initials), reversed(fault), strict=True):
        extra = CUT_SHORT if what == TRUNCATED else 0
        here = []
        for s in range(STATES):
            best = COST[DELETE] + after[s]
            if what not in (BLANK, DUPLICATE):
                if initial in FOLLOW[s]:
                    best = min(best, COST[KEEP] + extra + after[FOLLOW[s][initial]])
                for to, _ in _PUTS[s]:
                    best = min(best, COST[REROLE] + extra + after[to])
            here.append(best)
        after = _insertions(here)
        out.append(after)
    return out[::-1]


def optimal_arcs(cost: np.ndarray, initial: np.ndarray, fault: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each edit and node (row, state) the states, as bits, that optimal arcs lead to.

    The rows of all conversations follow each other; each one's last row is its end (`end`), for
    which `initial` and `fault` have no meaning.
    """
    n = len(cost)
    arcs = np.zeros((len(EDITS), n, STATES), np.int64)
    after = np.vstack([cost[1:], np.full((1, STATES), _FAR)])
    stays = ~end & (fault != BLANK) & (fault != DUPLICATE)
    extra = np.where(fault == TRUNCATED, CUT_SHORT, 0)
    for s in range(STATES):
        arcs[DELETE, :, s] = np.where(~end & (cost[:, s] == COST[DELETE] + after[:, s]), 1 << s, 0)
        for letter, to in FOLLOW[s].items():
            fits = stays & (initial == letter) & (cost[:, s] == COST[KEEP] + extra + after[:, to])
            arcs[KEEP, :, s] |= np.where(fits, 1 << to, 0)
        for to, _ in _PUTS[s]:
            fits = stays & (cost[:, s] == COST[REROLE] + extra + after[:, to])
            arcs[REROLE, :, s] |= np.where(fits, 1 << to, 0)
            arcs[INSERT, :, s] |= np.where(cost[:, s] == COST[INSERT] + cost[:, to], 1 << to, 0)
    return arcs


def _over(mask: np.ndarray, row: np.ndarray, values: np.ndarray, none: int):
    """For each state, the values (rows x states) of the nodes of `row` that `mask` has, else `none`."""
    for s in range(STATES):
        yield np.where(mask >> s & 1 == 1, values[row, s], none)


def rank(arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ranks of all nodes by their least whole audits, label of their first edit or -1 at the end)."""
    n = arcs.shape[1]
    has = arcs > 0
    label = np.where(has.any(axis=0), has.argmax(axis=0), -1)
    rows = np.arange(n)[:, None]
    states = np.arange(STATES)[None, :]
    # nodes without an edit are at their end and lead to themselves
    mask = np.where(label >= 0, np.take_along_axis(arcs, np.maximum(label, 0)[None], axis=0)[0], 1 << states)
    to = np.where((label >= 0) & (label != INSERT), rows + 1, rows)
    known, ranks = np.unique(label, return_inverse=True)
    ranks = ranks.reshape(label.shape)
    while True:
        none = ranks.max() + 1
        least = np.minimum.reduce(list(_over(mask, to, ranks, none)))
        found, doubled = np.unique(ranks * (none + 1) + least, return_inverse=True)
        if len(found) == len(known):  # twice the length tells no more nodes apart
            return ranks, label
        further, beyond = np.zeros_like(mask), to
        for s in range(STATES):
            chosen = (mask >> s & 1 == 1) & (ranks[to, s] == least)
            further |= np.where(chosen, mask[to, s], 0)
            beyond = np.where(chosen, to[to, s], beyond)
        known, ranks, mask, to = found, doubled.reshape(label.shape), further, beyond


def successors(arcs: np.ndarray, ranks: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The node after each node on its least path (itself at the end); node = row * STATES + state."""
    n = arcs.shape[1]
    rows = np.repeat(np.arange(n)[:, None], STATES, axis=1)
    own = rows * STATES + np.arange(STATES)
    mask = np.take_along_axis(arcs, np.maximum(label, 0)[None], axis=0)[0]
    to = np.minimum(np.where(label == INSERT, rows, rows + 1), n - 1)
    least = np.stack(list(_over(mask, to, ranks, ranks.max() + 1))).argmin(axis=0)
    return np.where(label >= 0, to * STATES + least, own).ravel()


def paths(starts: np.ndarray, after: np.ndarray, longest: int) -> np.ndarray:
    """The nodes from each start on, `longest` at least, by doubled pointers."""
    jumps = [after]
    while 1 << len(jumps) < longest:
        jumps.append(jumps[-1][jumps[-1]])
    nodes = starts[:, None]
    for jump in reversed(jumps):
        nodes = np.stack([nodes, jump[nodes]], axis=-1).reshape(len(starts), -1)
    return nodes


def repair_batch(convs: list[list[tuple[str, str]]]) -> list[dict]:
    """Counts, cost, audit and repaired (role, text) of conversations, each a list of (role, text)."""
    fault = [faults(c) for c in convs]
    initials = [[r[:1] for r, _ in c] for c in convs]
    cost = np.array([x for i, f in zip(initials, fault, strict=True) for x in costs(i, f)]).reshape(-1, STATES)
    letter = np.array([x for i in initials for x in (*i, "")] or [""], dtype="U1")[: len(cost)]
    what = np.array([x for f in fault for x in (*f, -1)], np.int64)
    sizes = np.array([len(c) + 1 for c in convs], np.int64)
    begins = np.cumsum(sizes) - sizes
    end = np.zeros(len(cost), bool)
    end[begins + sizes - 1] = True
    arcs = optimal_arcs(cost, letter, what, end)
    ranks, label = rank(arcs)
    after = successors(arcs, ranks, label)
    labels = label.ravel()
    # a row is passed by one edit and has two insertions before it at most
    longest = 3 * sizes
    classes = np.ceil(np.log2(longest)).astype(int)
    walked: dict[int, np.ndarray] = {}
    for c in np.unique(classes):
        at = np.flatnonzero(classes == c)
        walked |= zip(at.tolist(), paths(begins[at] * STATES, after, 1 << int(c)), strict=True)
    out = []
    for k, conv in enumerate(convs):
        nodes = walked[k]
        edits = labels[nodes]
        edits = edits[: np.flatnonzero(edits < 0)[0]]
        states = nodes[1 : len(edits) + 1] % STATES
        repaired, rest = [], iter(conv)
        for edit, state in zip(edits.tolist(), states.tolist(), strict=True):
            row = None if edit == INSERT else next(rest)
            if edit == KEEP:
                repaired.append(row)
            elif edit == REROLE:
                repaired.append((ROLE_OF[state], row[1]))
            elif edit == INSERT:
                repaired.append((ROLE_OF[state], ""))
        pairs = zip(initials[k][:-1], initials[k][1:], strict=True)
        out.append(
            {
                "blank": fault[k].count(BLANK),
                "duplicate": fault[k].count(DUPLICATE),
                "truncated": fault[k].count(TRUNCATED),
                "illegal": sum(a + b not in SOUND for a, b in pairs),
                "cost": int(cost[begins[k], 0]),
                "audit": "".join(EDITS[e] for e in edits.tolist()),
                "roles": [r for r, _ in repaired],
                "texts": [t for _, t in repaired],
            }
        )
    return out


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SCHEMA = (
    "conv_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    + ", audit string, roles array<string>, texts array<string>"
)


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _results(done: list[tuple[int | None, list]]) -> pa.RecordBatch:
    found = repair_batch([[(r, t) for _, r, t in rows] for _, rows in done])
    columns = {"conv_id": [c for c, _ in done], "gaps": [_gaps([t for t, _, _ in rows]) for _, rows in done]}
    columns |= {k: [f[k] for f in found] for k in (*_COUNTS[1:], "audit", "roles", "texts")}
    types = dict.fromkeys(("conv_id", *_COUNTS), pa.int64())
    types |= {"audit": pa.string(), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string())}
    return pa.RecordBatch.from_arrays([pa.array(columns[k], types[k]) for k in types], list(types))


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation; results go out when enough conversations are complete."""
    done: list = []
    held = 0
    for batch in batches:
        for conv, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not done or done[-1][0] != conv:
                if held >= AT_ONCE:
                    yield _results(done)
                    done, held = [], 0
                done.append((conv, []))
                held += 1
            if present:
                done[-1][1].append((turn, role, text))
                held += 1
    if done:
        yield _results(done)


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, roles and texts (the repaired
    turns) of every conversation.
    """
    ship(turns.sparkSession)
    space = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"),
    )
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
        .mapInArrow(_work, _SCHEMA)
    )
