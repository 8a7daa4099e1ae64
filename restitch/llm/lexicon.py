"""A word lexicon as a minimal acyclic transducer in flat, memory-mapped arrays.

Words are byte strings, outputs are lists of token ids.  The automaton is built from
sorted words with suffix sharing (each finished state is merged with an equal one), so
it has the least number of states.  Every state knows how many words it reaches; the
sums of those numbers along a path give the word's position in the sorted list, and
the position selects its ids.  Arcs are kept as one sorted array of
(state << 8 | byte), so whole batches of words are looked up together by binary search.
"""

from __future__ import annotations

import io
import os
import uuid

import numpy as np


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self) -> None:
        self.arcs: dict[int, _State] = {}
        self.final = False
        self.number = -1
        self.words = 0

    def signature(self) -> tuple:
        return (self.final, tuple((b, t.number) for b, t in self.arcs.items()))


def compile_words(entries: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """The arrays of the transducer for word -> ids; words may be empty, ids may not."""
    words = sorted(entries)
    register: dict[tuple, _State] = {}
    states: list[_State] = []
    root = _State()
    path: list[tuple[_State, int]] = []  # the unfinished states of the last word
    last = b""

    def finish(depth: int) -> None:
        """Replace or register the states of the last word below ``depth``."""
        while len(path) > depth:
            parent, byte = path.pop()
            child = parent.arcs[byte]
            key = child.signature()
            same = register.get(key)
            if same is None:
                child.number = len(states) + 1
                states.append(child)
                register[key] = child
            else:
                parent.arcs[byte] = same

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        finish(common)
        node = path[-1][0].arcs[path[-1][1]] if path else root
        for byte in word[common:]:
            new = _State()
            node.arcs[byte] = new
            path.append((node, byte))
            node = new
        node.final = True
        last = word
    finish(0)
    root.number = 0
    everyone = [root, *states]
    for s in [*states, root]:  # children were finished before their parents
        s.words = s.final + sum(t.words for t in s.arcs.values())

    keys, targets, skipped = [], [], []
    for s in sorted(everyone, key=lambda x: x.number):
        before = int(s.final)
        for byte, t in sorted(s.arcs.items()):
            keys.append(s.number << 8 | byte)
            targets.append(t.number)
            skipped.append(before)
            before += t.words
    ids = [entries[w] for w in words]
    return {
        "key": np.array(keys, dtype=np.uint64),
        "target": np.array(targets, dtype=np.uint32),
        "skip": np.array(skipped, dtype=np.uint32),
        "final": np.array([s.final for s in sorted(everyone, key=lambda x: x.number)], dtype=np.uint8),
        "offset": np.cumsum([0, *map(len, ids)]).astype(np.uint32),
        "ids": np.array([i for x in ids for i in x], dtype=np.uint32),
    }


_ORDER = ("key", "target", "skip", "final", "offset", "ids")


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """One header of counts, then the arrays, each aligned to eight bytes."""
    out = io.BytesIO()
    out.write(np.array([len(arrays[n]) for n in _ORDER], dtype=np.uint64).tobytes())
    for n in _ORDER:
        raw = arrays[n].tobytes()
        out.write(raw + b"\0" * (-len(raw) % 8))
    return out.getvalue()


_DTYPE = {"key": np.uint64, "target": np.uint32, "skip": np.uint32, "final": np.uint8, "offset": np.uint32, "ids": np.uint32}


class Lexicon:
    """Lookup over the arrays of ``compile_words``, from a mapped file or from bytes."""

    def __init__(self, source: str | bytes) -> None:
        raw = np.memmap(source, dtype=np.uint8, mode="r") if isinstance(source, str) else np.frombuffer(source, dtype=np.uint8)
        counts = raw[: 8 * len(_ORDER)].view(np.uint64)
        at = 8 * len(_ORDER)
        for n, count in zip(_ORDER, counts, strict=True):
            size = int(count) * np.dtype(_DTYPE[n]).itemsize
            setattr(self, n, raw[at : at + size].view(_DTYPE[n]))
            at += size + (-size % 8)

    def positions(self, words: list[bytes]) -> np.ndarray:
        """Position of each word in the sorted list, -1 for words outside the lexicon."""
        n = len(words)
        if not n or not len(self.key):
            known = bool(len(self.final)) and bool(self.final[0])
            return np.array([0 if known and not w else -1 for w in words], dtype=np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        state = np.zeros(n, dtype=np.uint64)
        position = np.zeros(n, dtype=np.int64)
        alive = np.ones(n, dtype=bool)
        for p in range(int(lengths.max(initial=0))):
            at = np.flatnonzero(alive & (lengths > p))
            if not len(at):
                break
            key = state[at] << np.uint64(8) | flat[starts[at] + p].astype(np.uint64)
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[arc] == key
            alive[at[~hit]] = False
            at, arc = at[hit], arc[hit]
            position[at] += self.skip[arc]
            state[at] = self.target[arc]
        ok = alive & (self.final[state.astype(np.int64)] == 1)
        return np.where(ok, position, -1)

    def ids_at(self, position: int) -> list[int]:
        return self.ids[self.offset[position] : self.offset[position + 1]].tolist()


def publish(data: bytes, shared: str) -> str | None:
    """Write the lexicon to the shared folder under its content's name; None where that is not a mounted folder."""
    import hashlib

    if shared.startswith("file:"):
        shared = "/" + shared[5:].lstrip("/")
    if "://" in shared or not shared.startswith("/"):
        return None
    folder = os.path.join(shared, "restitch-lexicon")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, hashlib.sha256(data).hexdigest()[:24] + ".fst")
    if not os.path.exists(path):
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
    return path
