"""URL filter: all glob rules as one bit-parallel Shift-And automaton.

A canonical URL is ``.host/path``.  Every rule becomes a chain of states; the states of all rules
lie side by side in a few 64-bit words.  One step reads one byte of every URL of a batch at once:
``D = ((D << 1) & move[byte]) | (D & stay[byte])``, where ``stay`` holds the states in front of a
wildcard.  A rule matches if its last state is set when the URL ends.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_list, slices

#: The rules that the contract names, (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: The method's own globs for URLs that no rule fits; the first that matches decides, else DEFAULT.
GLOBS = (("block", "*spam*"), ("block", "*spam*/**"))
DEFAULT = "allow"

_ANY, _NOT_SLASH = object(), object()
FEW = 8  # URLs that outlast the others are finished one by one on Python integers


def glob_pattern(glob: str) -> list:
    """``*`` is any run without a slash, ``**`` any run, a backslash makes the next sign plain."""
    out, i, raw = [], 0, glob
    while i < len(raw):
        if raw[i] == "\\" and i + 1 < len(raw):
            out += list(raw[i + 1].encode())
            i += 2
        elif raw.startswith("**", i):
            out.append(_ANY)
            i += 2
        elif raw[i] == "*":
            out.append(_NOT_SLASH)
            i += 1
        else:
            out += list(raw[i].encode())
            i += 1
    return out


def rule_patterns(host: str, path: str) -> list[list]:
    """The host itself and all its subdomains, with all paths that start with ``path``."""
    head = [_NOT_SLASH, *f".{host}".encode()]
    if path:
        return [[*head, *path.encode(), _ANY]]
    return [head, [*head, *b"/", _ANY]]


class ShiftAnd:
    """All patterns as one automaton over bytes."""

    def __init__(self, patterns: list[list]):
        states, moves, stays, starts, ends = 0, [], [], [], []
        for p in patterns:
            starts.append(states)
            for x in p:
                if x is _ANY or x is _NOT_SLASH:
                    stays.append((states, x))
                else:
                    states += 1
                    moves.append((states, x))
            ends.append(states)
            states += 1
        self.words = max(1, -(-states // 64))
        self.ends = ends
        move, stay = [0] * 256, [0] * 256
        for bit, byte in moves:
            move[byte] |= 1 << bit
        for bit, kind in stays:
            for byte in range(256):
                if kind is _ANY or byte != 0x2F:
                    stay[byte] |= 1 << bit
        self.start = sum(1 << s for s in starts)
        self.move_int, self.stay_int = move, stay
        self.move, self.stay = self._rows(move), self._rows(stay)

    def _rows(self, masks: list[int]) -> np.ndarray:
        full = (1 << 64) - 1
        return np.array([[m >> (64 * w) & full for w in range(self.words)] for m in masks], np.uint64)

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """Boolean (url, pattern)."""
        n = len(urls)
        out = np.zeros((n, len(self.ends)), bool)
        if not n:
            return out
        length = np.array([len(u) for u in urls])
        order = np.argsort(-length, kind="stable")
        buf = np.frombuffer(b"".join(urls) + b"\0", np.uint8)
        first = (np.cumsum(length) - length)[order]
        length = length[order]
        state = np.repeat(self._rows([self.start]), n, axis=0)
        carry, one = np.uint64(63), np.uint64(1)
        live, at = n, 0
        while True:
            live = int(np.searchsorted(-length, -at, side="left"))  # URLs longer than ``at``
            if live <= FEW:
                break
            byte = buf[first[:live] + at]
            d = state[:live]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> carry
            state[:live] = (moved & self.move[byte]) | (d & self.stay[byte])
            at += 1
        final = [sum(int(w) << (64 * i) for i, w in enumerate(state[k])) for k in range(live)]
        for k in range(live):
            d = final[k]
            for byte in buf[first[k] + at:first[k] + length[k]].tolist():
                d = ((d << 1) & self.move_int[byte]) | (d & self.stay_int[byte])
                if not d:
                    break
            state[k] = self._rows([d & ((1 << (64 * self.words)) - 1)])[0]
        for j, bit in enumerate(self.ends):
            out[order, j] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one == one
        return out


def _judge(batches, rules, globs, default: str):
    patterns, owner = [], []
    for i, (_, host, path) in enumerate(rules):
        for p in rule_patterns(host, path):
            patterns.append(p)
            owner.append(i)
    for i, (_, glob) in enumerate(globs):
        patterns.append(glob_pattern(glob))
        owner.append(len(rules) + i)
    automaton, owner = ShiftAnd(patterns), np.array(owner, int)
    names = [h + p for _, h, p in rules]
    # the longest rule first, then the globs in their order
    rank = sorted(range(len(rules)), key=lambda i: (-len(names[i]), i)) + list(
        range(len(rules), len(rules) + len(globs)))
    verdicts = [v for v, *_ in rules] + [v for v, _ in globs] + [default]
    for batch in batches:
        for part in slices(batch, "path"):
            urls = [b"." + h + p for h, p in zip(byte_list(part.column("host")), byte_list(part.column("path")))]
            hits = automaton.matches(urls)
            choice = np.full(len(urls), len(verdicts) - 1)
            for i in reversed(rank):
                choice[hits[:, owner == i].any(axis=1)] = i
            rule = pa.array([names[c] if c < len(names) else None for c in choice], pa.string())
            verdict = pa.array([verdicts[c] for c in choice], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("host"), part.column("path"), rule, verdict],
                names=["page_id", "host", "path", "rule", "verdict"])


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` with A-Z lower-cased; both empty without it."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substr(url, at + 3)).otherwise("")
    upper = "".join(map(chr, range(65, 91)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, upper.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules=RULES, globs=GLOBS, default: str = DEFAULT) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.

    ``rules`` are (verdict, host, path): a rule fits its host and all subdomains if the URL's path
    starts with the rule's; of several the longest (host and path together) wins, then the
    earlier.  If none fits, ``rule`` is null and the first matching glob decides, else ``default``.
    A null URL or one without ``://`` has empty host and path.  Null page_id stays null; repeated
    rows are judged one by one; extra columns are ignored.  Memory is bounded by the longest URL.
    """
    host, path = url_parts(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return rows.mapInArrow(partial(_judge, rules=tuple(rules), globs=tuple(globs), default=default),
                           "page_id long, host string, path string, rule string, verdict string")
