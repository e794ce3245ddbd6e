"""Literals that every match of a pattern must hold, derived from the pattern itself, and one pass that finds them all."""

from __future__ import annotations

import re
import re._parser as parser

import ahocorasick

#: Alternatives of a small class of characters that are spelled out.
SPELLED = 6


def _choices(op: str, arg) -> list[str] | None:
    """All texts of a simple item, if they are few."""
    if op == "LITERAL":
        return [chr(arg)]
    if op == "IN" and len(arg) <= SPELLED and all(str(k) == "LITERAL" for k, _ in arg):
        return [chr(v) for _, v in arg]
    return None


def _of(items) -> set[str] | None:
    """Literals one of which is in every match of a sequence: the best of its parts (the longer the shortest of them, the better)."""
    found: list[set[str]] = []
    run: set[str] = {""}

    def close() -> None:
        nonlocal run
        if run != {""}:
            found.append(run)
        run = {""}

    for op, arg in items:
        op = str(op)
        few = _choices(op, arg)
        if few is not None and len(run) * len(few) <= 4 * SPELLED:
            run = {a + b for a in run for b in few}
            continue
        if op in ("AT", "ASSERT_NOT"):
            continue
        close()
        if op == "SUBPATTERN":
            inner = _of(arg[-1])
        elif op == "BRANCH":
            parts = [_of(x) for x in arg[1]]
            inner = None if any(p is None for p in parts) else set().union(*parts)
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            inner = _of(arg[2]) if arg[0] > 0 else None
        elif op == "ASSERT":
            inner = _of(arg[1]) if arg[0] > 0 else None
        else:
            inner = None
        if inner:
            found.append(inner)
    close()
    return max(found, key=lambda s: min(map(len, s)), default=None)


def literals(pattern: re.Pattern) -> set[str]:
    """Lower-case literals one of which is in the lower-cased text of every match; an error if the pattern has none."""
    got = _of(parser.parse(pattern.pattern, pattern.flags & ~re.UNICODE))
    if not got:
        raise ValueError(f"no literal is implied by {pattern.pattern[:80]}")
    return {x.lower() for x in got}


def alternatives(pattern: re.Pattern) -> list[re.Pattern]:
    """The pattern's branches at the top level, each on its own; one that begins with a flag keeps it."""
    text, flag = pattern.pattern, ""
    if text.startswith("(?i)"):
        text, flag = text[4:], "(?i)"
    out, depth, at, i = [], 0, 0, 0
    in_class = False
    while i < len(text):
        c = text[i]
        if c == "\\":
            i += 1
        elif in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
            i += text[i + 1 : i + 2] == "]"
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(text[at:i])
            at = i + 1
        i += 1
    return [re.compile(flag + x) for x in [*out, text[at:]]]


class Finder:
    """Which of several patterns can match in a text at all, as the bits of a number."""

    def __init__(self, patterns: list[re.Pattern]) -> None:
        bits: dict[str, int] = {}
        for i, p in enumerate(patterns):
            for x in literals(p):
                bits[x] = bits.get(x, 0) | 1 << i
        self.automaton = ahocorasick.Automaton()
        for x, b in bits.items():
            self.automaton.add_word(x, b)
        self.automaton.make_automaton()

    def bits(self, low: str) -> int:
        out = 0
        for _, b in self.automaton.iter(low):
            out |= b
        return out
