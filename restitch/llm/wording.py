"""Large sets of wordings searched by their necessary strings first.

A pattern of many alternatives is split into them.  Of each one the strings of which every match
must hold at least one are read off its parse tree; one automaton finds all of these strings in a
text at once, and only the alternatives whose strings occur are tried.  The result is that of the
whole pattern: the leftmost match, of equal starts the one of the first alternative.
"""

from __future__ import annotations

import re
import re._parser as parser

import ahocorasick

#: Characters that match another one without regard to case only where their lower-case forms are the same.
_PLAIN = re.compile(r"[\x00-\x7f\xa0-\xff‐-‧]*")


def required(tree) -> set[str]:  # noqa: ANN001 - a parsed pattern
    """Lower-case strings of which every match of a pattern holds at least one; empty when none can be told."""
    found: list[set[str]] = []
    run = ""
    for op, what in [*tree, (None, None)]:
        if op is parser.LITERAL:
            run += chr(what).lower()
            continue
        if run:
            found.append({run})
            run = ""
        if op is parser.SUBPATTERN:
            found.append(required(what[-1]))
        elif op is parser.MAX_REPEAT and what[0] > 0:
            found.append(required(what[2]))
        elif op is parser.BRANCH:
            each = [required(x) for x in what[1]]
            found.append(set().union(*each) if all(each) else set())
    return max((x for x in found if x), key=lambda x: min(map(len, x)), default=set())


def alternatives(pattern: str) -> list[str]:
    """The top-level alternatives of a verbose pattern without comments."""
    out, depth, inside, cur, i = [], 0, False, "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            cur += pattern[i : i + 2]
            i += 2
            continue
        if inside:
            inside = c != "]" or cur[-1:] == "[" or cur[-2:] == "[^"
        elif c == "[":
            inside = True
        elif c == "|" and depth == 0:
            out.append(cur)
            cur = ""
            i += 1
            continue
        else:
            depth += (c == "(") - (c == ")")
        cur += c
        i += 1
    return [x for x in [*out, cur] if x.strip()]


class Wording:
    """A verbose, case-blind pattern of many alternatives."""

    def __init__(self, pattern: str) -> None:
        self.parts = [re.compile("(?ix)" + a) for a in alternatives(pattern)]
        self.always: list[int] = []
        signs: dict[str, list[int]] = {}
        for i, a in enumerate(alternatives(pattern)):
            need = required(parser.parse("(?ix)" + a))
            if not need:
                self.always.append(i)
            for x in need:
                signs.setdefault(x, []).append(i)
        self.signs = signs
        self.automaton = ahocorasick.Automaton()
        for x, ids in signs.items():
            self.automaton.add_word(x, tuple(ids))
        if signs:
            self.automaton.make_automaton()

    def candidates(self, text: str) -> list[int]:
        if not self.signs:
            return self.always
        if not text.isascii() and not _PLAIN.fullmatch(text):
            return list(range(len(self.parts)))
        found = set(self.always)
        for _, ids in self.automaton.iter(text.lower()):
            found.update(ids)
        return sorted(found)

    def search(self, text: str) -> re.Match | None:
        best = None
        for i in self.candidates(text):
            m = self.parts[i].search(text)
            if m is not None and (best is None or m.start() < best.start()):
                best = m
        return best

    def __reduce__(self):  # noqa: ANN204 - an automaton is built again where it is needed
        return Wording, ("|".join(p.pattern.removeprefix("(?ix)") for p in self.parts),)
