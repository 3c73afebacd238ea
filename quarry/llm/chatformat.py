"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system message and then user and assistant in turn, starting
with user and ending with assistant; tool messages may follow an assistant and lead back to one.  The states of
that automaton are the roles a message can end in.  Every turn is a small (min, +) matrix over
the states: what it costs to get from one state to another by keeping the turn, relabelling it, merging it
into the message before, or inserting an empty message in front of it.  The product of such matrices is associative, so a
conversation is cut into segments of bounded size: segments are reduced to one matrix each in
parallel, the few matrices of a conversation give the cheapest states at its cuts, and every
segment then finds its own path between its two fixed ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize

#: The states: before the first message, then the role of the last one.
STATES = ("start", "system", "user", "assistant", "tool")
START, SYSTEM, USER, ASSISTANT, TOOL = range(5)
#: Which roles may follow a state.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER, TOOL), TOOL: (ASSISTANT, TOOL)}
END = (ASSISTANT,)
#: Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant",
           "model": "assistant", "ai": "assistant", "agent": "assistant", "developer": "system",
           "function": "tool", "observation": "tool"}
MERGE, INSERT, RELABEL, UNKNOWN = 1.0, 1.5, 4.0, 2.0
SEGMENT_ROWS = 4096
SEGMENT_CHARS = 1 << 22


def _step_options():
    """(from state, to state, action, inserted roles, kept role) without the cost of a relabel."""
    out = []
    for s in range(5):
        for r in LEGAL[s]:
            out.append((s, r, "keep", (), r, 0.0))
        if s != START:
            out.append((s, s, "merge", (), s, MERGE))
        for mid in LEGAL[s]:
            for r in LEGAL[mid]:
                out.append((s, r, "insert", (mid,), r, INSERT))
            for mid2 in LEGAL[mid]:
                for r in LEGAL[mid2]:
                    out.append((s, r, "insert", (mid, mid2), r, 2 * INSERT))
    return out


_OPTIONS = _step_options()


def _tables():
    """For every role of a turn (the last index: unknown) the cost matrix and the best option."""
    cost = np.full((6, 5, 5), np.inf)
    best = {}
    for role in range(1, 6):
        for o in _OPTIONS:
            s, t, action, inserted, kept, c = o
            if role == 5:
                c += UNKNOWN if kept != SYSTEM else RELABEL
            elif kept != role:
                c += RELABEL
            if c < cost[role, s, t] - 1e-9:
                cost[role, s, t] = c
                best[role, s, t] = o
    return cost, best


COST, BEST = _tables()
#: What closing a conversation in a state costs, and the empty messages it takes.
CLOSE = {ASSISTANT: (0.0, ()), USER: (INSERT, (ASSISTANT,)), SYSTEM: (2 * INSERT, (USER, ASSISTANT)),
         TOOL: (INSERT, (ASSISTANT,)), START: (2 * INSERT, (USER, ASSISTANT))}


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return STATES.index(name) if name in STATES[1:] else 5


def _product(codes: np.ndarray) -> np.ndarray:
    """The (min, +) product of the turns' matrices."""
    out = np.where(np.eye(5, dtype=bool), 0.0, np.inf)
    for c in codes:
        out = (out[:, :, None] + COST[c][None, :, :]).min(axis=1)
    return out


def _path(codes: np.ndarray, first: int, last: int) -> list[tuple]:
    """The cheapest options from state ``first`` to ``last``; of equal costs the smaller state."""
    n = len(codes)
    value = np.full((n + 1, 5), np.inf)
    value[n, last] = 0
    for i in range(n - 1, -1, -1):
        value[i] = (COST[codes[i]] + value[i + 1][None, :]).min(axis=1)
    out, state = [], first
    for i in range(n):
        to = int((COST[codes[i]][state] + value[i + 1]).argmin())
        out.append(BEST[int(codes[i]), state, to])
        state = to
    return out


def _segments(batches):
    """Number the rows of a sorted partition into segments of bounded rows and characters."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    segment, rows, chars, n = 0, 0, 0, 0
    for pdf in batches:
        size = pdf.text.str.len().fillna(0).to_numpy()
        numbers = np.empty(len(pdf), np.int64)
        for i, c in enumerate(size):
            if rows >= SEGMENT_ROWS or chars >= SEGMENT_CHARS:
                segment, rows, chars = segment + 1, 0, 0
            rows, chars = rows + 1, chars + int(c)
            numbers[i] = segment
        yield pdf.assign(part=np.int64(part), segment=numbers, place=np.arange(n, n + len(pdf), dtype=np.int64))
        n += len(pdf)


def _conversations(pdf: pd.DataFrame):
    """(sorted rows, role codes, start and end of every conversation) of a segment."""
    pdf = pdf.sort_values("place", ignore_index=True)
    conv = pdf.conv_id.to_numpy()
    cut = np.flatnonzero(conv[1:] != conv[:-1]) + 1
    known = {r: role_code(r) for r in pdf.role.unique()}
    codes = np.array([known[r] for r in pdf.role], int)
    return pdf, codes, [0, *cut.tolist()], [*cut.tolist(), len(pdf)]


def _matrix(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for each conversation of a segment: its matrix, flattened."""
    pdf, codes, starts, ends = _conversations(pdf)
    conv = pdf.conv_id.to_numpy()
    out = [(conv[a], _product(codes[a:b]).ravel().tolist()) for a, b in zip(starts, ends)]
    return pd.DataFrame(out, columns=["conv_id", "matrix"]).assign(part=pdf.part.iloc[0], segment=pdf.segment.iloc[0])


def _cuts(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states at both ends of every segment of one conversation."""
    pdf = pdf.sort_values(["part", "segment"])
    mats = [np.array(m, float).reshape(5, 5) for m in pdf.matrix]
    value = np.array([CLOSE[s][0] for s in range(5)])
    back = [value]
    for m in reversed(mats):
        value = (m + value[None, :]).min(axis=1)
        back.append(value)
    back.reverse()
    state, first, last = START, [], []
    for m, v in zip(mats, back[1:]):
        first.append(state)
        state = int((m[state] + v).argmin())
        last.append(state)
    ends = [False] * (len(mats) - 1) + [True]
    return pd.DataFrame({"conv_id": pdf.conv_id, "part": pdf.part, "segment": pdf.segment, "first": first,
                         "last": last, "ends": ends})


def _fragment(role: int, text: str, merged: bool) -> str:
    """A rendered message without its end mark, which the next message or the close supplies."""
    return f"\n{text}" if merged else f"<|{STATES[role]}|>\n{text}"


def _render(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    pdf, codes, starts, stops = _conversations(pdf)
    part = int(pdf.part.iloc[0])
    convs, turns, places = pdf.conv_id.tolist(), pdf.turn.tolist(), pdf.place.tolist()
    roles, texts = pdf.role.tolist(), pdf.text.tolist()
    firsts, lasts, closes = pdf["first"].tolist(), pdf["last"].tolist(), pdf.ends.tolist()
    for a, b in zip(starts, stops):
        conv, first, last = convs[a], int(firsts[a]), int(lasts[a])
        opened = first != START
        for i, (_, _, action, inserted, kept, _) in enumerate(_path(codes[a:b], first, last), a):
            turn, place, step = turns[i], places[i], 0
            for mid in inserted:
                out.append((conv, turn, part, place, step, "insert", None, STATES[mid],
                            ("<|end|>\n" if opened else "") + _fragment(mid, "", False)))
                opened, step = True, step + 1
            merged = action == "merge"
            did = "merge" if merged else "keep"
            if kept != codes[i]:
                did = "merge relabel" if merged else "relabel"
            out.append((conv, turn, part, place, step, did, roles[i], STATES[kept],
                        ("<|end|>\n" if opened and not merged else "") + _fragment(kept, texts[i] or "", merged)))
            opened = True
        if closes[a]:
            step = 8
            for mid in CLOSE[last][1]:
                out.append((conv, turns[b - 1], part, places[b - 1], step, "insert", None, STATES[mid],
                            "<|end|>\n" + _fragment(mid, "", False)))
                step += 1
            out.append((conv, turns[b - 1], part, places[b - 1], step, "end", None, None, "<|end|>\n"))
    return pd.DataFrame(out, columns=["conv_id", "turn", "part", "place", "step", "action", "role", "new_role",
                                      "fragment"])


OUTPUT = ("conv_id long, turn long, part long, place long, step int, action string, role string, "
          "new_role string, fragment string")


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired conversations, one row per message part, in order of (part, place, step).

    Columns: conv_id, turn, part, place, step, action (keep, merge, relabel, merge relabel, insert,
    end), role, new_role, fragment.  The fragments of a conversation, joined in that order, are its rendered text.
    The repair is of least total cost: a merge 1, an empty message 1.5, a relabel 4, an unknown or
    null role 2 for any role but system.

    Turns are taken in order of (turn, role, text); a null turn comes first; fully equal rows of a
    conversation count once.  Null text is empty.  Rows without conv_id form one conversation.
    Extra columns are ignored.

    Rows are range-partitioned and sorted, so a huge conversation spreads over many partitions,
    and written with their segment numbers: a lost task finds the same segments again.  A segment
    holds at most ``SEGMENT_ROWS`` rows and about ``SEGMENT_CHARS`` characters (one row at
    least).  Only one 5 x 5 matrix per segment and conversation is brought together.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).distinct()
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        _segments, "conv_id long, turn long, role string, text string, part long, segment long, place long")
    # pandas drops null keys of a group, so null conversations get a mark of their own
    rows = materialize(rows.withColumn("nil", F.col("conv_id").isNull()).fillna(0, ["conv_id"]), "segments")
    matrices = rows.select("nil", "conv_id", "role", "part", "segment", "place").groupBy(
        "nil", "part", "segment").applyInPandas(
        lambda k, p: _matrix(p).assign(nil=k[0]),
        "conv_id long, part long, segment long, matrix array<double>, nil boolean")
    cuts = matrices.groupBy("nil", "conv_id").applyInPandas(
        lambda k, p: _cuts(p).assign(nil=k[0]),
        "conv_id long, part long, segment long, first int, last int, ends boolean, nil boolean")
    joined = rows.join(cuts, ["nil", "conv_id", "part", "segment"])
    out = joined.groupBy("nil", "part", "segment").applyInPandas(
        lambda k, p: _render(p.assign(turn=p.turn.astype("Int64"))).assign(nil=k[0]), OUTPUT + ", nil boolean")
    return out.withColumn("conv_id", F.when(~F.col("nil"), F.col("conv_id"))).drop("nil")
