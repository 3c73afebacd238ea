"""Role repair against a plain search over all repairs."""

import heapq
import random

from quarry.llm import chatformat as C


def _least_cost(codes):
    """Dijkstra over (turns read, state), written from the legal-turn rules."""
    legal = {0: (1, 2), 1: (2,), 2: (3,), 3: (2, 4), 4: (3, 4)}
    heap, done = [(0.0, 0, 0, 0)], set()
    while heap:
        cost, i, state, added = heapq.heappop(heap)
        if (i, state, added) in done:
            continue
        done.add((i, state, added))
        if i == len(codes) and state == 3:
            return cost
        if added < 2:
            for r in legal[state]:
                heapq.heappush(heap, (cost + 1.5, i, r, added + 1))
        if i < len(codes):
            def price(r):
                return 0.0 if codes[i] == r else 2.0 if codes[i] == 5 and r != 1 else 4.0
            for r in legal[state]:
                heapq.heappush(heap, (cost + price(r), i + 1, r, 0))
            if state and not added:
                heapq.heappush(heap, (cost + 1.0 + price(state), i + 1, state, 0))
    raise AssertionError


def _cost(rows):
    price = {"keep": 0, "merge": 1, "relabel": 4, "merge relabel": 5, "insert": 1.5, "end": 0}
    total = 0
    for r in rows:
        total += price[r.action]
        if "relabel" in r.action and C.role_code(r.role) == 5 and r.new_role != "system":
            total -= 2
    return total


def _legal(rows):
    seen = ["start"]
    for r in rows:
        if r.action in ("keep", "relabel", "insert"):
            seen.append(r.new_role)
        elif r.action.startswith("merge"):
            assert seen[-1] == r.new_role
    names = [C.STATES.index(s) for s in seen]
    assert all(b in C.LEGAL[a] for a, b in zip(names, names[1:])) and names[-1] == C.ASSISTANT


ROLES = ["user", "assistant", "system", "tool", "Human", "gpt", "???", None]


def _conversations(n=120):
    rng = random.Random(6)
    return [(c, t, rng.choice(ROLES), f"text {c} {t}") for c in range(n) for t in range(rng.randrange(1, 12))]


def _by_conversation(df):
    out = {}
    for r in df.orderBy("part", "place", "step").collect():
        out.setdefault(r.conv_id, []).append(r)
    return out


def test_repairs_are_legal_and_cheapest(spark):
    rows = _conversations()
    got = _by_conversation(C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    for c in {r[0] for r in rows}:
        codes = [C.role_code(r[2]) for r in sorted(rows, key=lambda r: r[:2]) if r[0] == c]
        _legal(got[c])
        assert abs(_cost(got[c]) - _least_cost(codes)) < 1e-9, codes
        text = "".join(r.fragment for r in got[c])
        assert text.startswith("<|") and text.endswith("<|end|>\n")
        assert text.count("<|end|>") == sum(r.action in ("keep", "relabel", "insert") for r in got[c])


def test_segments_do_not_change_the_result(spark, monkeypatch):
    rows = _conversations(40) + [(500, t, ROLES[t * 7 % 5], "x") for t in range(3000)]  # one huge conversation
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {c: "".join(r.fragment for r in v) for c, v in _by_conversation(C.repair(df)).items()}
    monkeypatch.setattr(C, "SEGMENT_ROWS", 7)
    assert {c: "".join(r.fragment for r in v) for c, v in _by_conversation(C.repair(df)).items()} == whole


def test_edge_cases(spark):
    """Null ids, turns, roles and texts; ties; repeated rows; clashing columns; a very long text."""
    rows = [(1, 1, "user", "a"), (1, 1, "user", "a"), (1, 1, "assistant", "b"), (2, None, "user", None), (None, 1, "user", "q"),
            (None, 2, "assistant", "r"), (3, 1, None, ""), (4, 1, "user", "z" * 500_000), (0, 1, "user", "zero")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS part", "2 AS segment", "3 AS nil", "4 AS fragment")
    got = {c: "".join(r.fragment for r in v) for c, v in _by_conversation(C.repair(df)).items()}
    assert got[None] == "<|user|>\nq<|end|>\n<|assistant|>\nr<|end|>\n"
    assert got[0] == "<|user|>\nzero<|end|>\n<|assistant|>\n<|end|>\n"
    assert got[2] == "<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert got[1].count("a<|end|>") == 1 and "b" in got[1]
    assert set(got) == {None, 0, 1, 2, 3, 4}
    assert C.repair(df.limit(0)).count() == 0
