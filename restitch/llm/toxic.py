"""Problem 3: abusive, hateful or sexual content.

A linear-chain conditional random field with the labels harmless and toxic tags the
words of each sentence.  Its features are hashes of the word, its neighbours and pairs
of them, after disguises are undone (letters for digits and signs, stretched and split
words, asterisks).  It is trained on the labelled sentences of toxic_examples.py and
toxic_more.py, a fixed and bounded set, in some twenty seconds.  Forward-backward marginals give each word's
probability; runs of likely words are spans with source offsets, and a document's score
is the chance that at least one of its spans is toxic.

Scoring works on whole batches of words: features are computed once per distinct word,
pairs by arithmetic on their hashes, and the recursions run over sentences in parallel.

Defined results: null and empty texts have score 0 and no spans; pages are scored by
their visible text; whole texts are read; repeated rows are each scored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restitch.llm.pageblocks import blocks
from restitch.llm import toxic_more
from restitch.llm.toxic_examples import ABUSIVE, HARMLESS, SLOTS
from restitch.session import spread

BITS = 22
#: Weights below this size are dropped after training: they say little, and words never seen may share their places.
LEAST_WEIGHT = 0.3
#: Words of a training sentence; longer ones are cut. Texts are tagged in whole sentences, in batches of CELLS words.
SEQUENCE = 64
CELLS = 2048 * SEQUENCE
WORD_P = 0.4
SPAN_SCORE = 0.9
DOCUMENT_SCORE = 0.5
# Signs that stand for letters, and words that asterisks usually hide.
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "€": "e", "+": "t", "|": "l"})
HIDDEN = "shit fuck fucked fucking bitch asshole cock dick pussy cunt slut whore bastard tits ass nude cum".split()

_TOKEN = re.compile(r"(?:[^\W_]['’]?[.\-_*]){2,}[^\W_]+(?![.\-_*]?\w)|[\w@$*!€+|][\w@$*!€+|'’\-]*", re.U)
_DENSE = re.compile(r"[぀-ヿ㐀-鿿฀-๿]")
_BREAK = re.compile(r"[.!?…。！？।؟]+[\"'”’»)\]]*(?=\s|$)|[。！？…]|\n\s*\n")


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end); scripts without spaces give single characters; "f u c k" is one word."""
    out: list[tuple[str, int, int]] = []
    for m in _TOKEN.finditer(text):
        w = m.group()
        if _DENSE.search(w):
            out += [(c, m.start() + i, m.start() + i + 1) for i, c in enumerate(w)]
            continue
        a, b = m.span()
        while b > a and text[b - 1] in "!'’-|+":
            b -= 1
        if b > a:
            out.append((text[a:b], a, b))
    merged: list[tuple[str, int, int]] = []
    i = 0
    while i < len(out):
        k = i
        while k < len(out) and len(out[k][0]) == 1 and out[k][0].isalpha() and not _DENSE.match(out[k][0]) and (k == i or out[k][1] - out[k - 1][2] <= 2):
            k += 1
        if k - i >= 3:
            merged.append(("".join(x[0] for x in out[i:k]), out[i][1], out[k - 1][2]))
            i = k
        else:
            merged.append(out[i])
            i += 1
    return merged


def _squeeze(w: str) -> str:
    return re.sub(r"(.)\1+", r"\1", w)


_HIDDEN = [(h, len(h)) for h in HIDDEN]


def plain(word: str) -> str:
    """The word without its disguise."""
    w = word.lower().replace("’", "'")
    if w[:1].isdigit() and not any(c.isalpha() for c in w):
        return "0"
    if w.isalpha():
        return _squeeze(w) if len(w) > 1 else w
    if "*" in w:
        rx = re.compile(re.escape(w.translate(SIGNS)).replace(r"\*", "[a-z]") + "$")
        for h, n in _HIDDEN:
            if n == len(w) and rx.match(h):
                return _squeeze(h)
    if any(c.isalpha() for c in w) and not re.fullmatch(r"\w*\d{3,}\w*|\d+\w{1,2}", w):
        w = w.translate(SIGNS)
        w = re.sub(r"[.\-_*]", "", w)
    return _squeeze(w)


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x27D4EB2F165667C5], dtype=np.uint64)


def word_hash(w: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(w.encode())


def features(h: np.ndarray) -> np.ndarray:
    """(B, T) word hashes, 0 for padding -> (B, T, 7) feature numbers."""
    with np.errstate(over="ignore"):
        left = np.pad(h, ((0, 0), (1, 0)))[:, :-1]
        right = np.pad(h, ((0, 0), (0, 1)))[:, 1:]
        left2 = np.pad(h, ((0, 0), (2, 0)))[:, :-2]
        right2 = np.pad(h, ((0, 0), (0, 2)))[:, 2:]
        parts = [h, left, right, left * np.uint64(31) + h, h * np.uint64(31) + right, left2 * np.uint64(961) + left * np.uint64(31) + h, h * np.uint64(961) + right * np.uint64(31) + right2]
        out = np.stack([(p + np.uint64(k + 1)) * m for k, (p, m) in enumerate(zip(parts, _MIX, strict=True))], axis=-1)
        out ^= out >> np.uint64(29)
        return (out & np.uint64((1 << BITS) - 1)).astype(np.int64)


class Tagger:
    """Two-state chain: one weight per feature for the toxic state, and transition scores."""

    def __init__(self) -> None:
        self.w = np.zeros(1 << BITS, dtype=np.float32)
        self.bias = -3.0  # fixed: a word without evidence is harmless
        self.step = np.zeros((2, 2))

    def marginals(self, feats: np.ndarray, mask: np.ndarray, want_pairs: bool = False):  # noqa: ANN201
        """P(toxic) of every word (B, T); with want_pairs also the expected transitions."""
        e = self.w[feats].sum(-1) + self.bias
        B, T = e.shape
        emit = np.zeros((B, T, 2))
        emit[..., 1] = e
        alpha = np.zeros((B, T, 2))
        beta = np.zeros((B, T, 2))
        alpha[:, 0] = emit[:, 0]
        for t in range(1, T):
            a = alpha[:, t - 1, :, None] + self.step[None]
            new = np.logaddexp(a[:, 0], a[:, 1]) + emit[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        for t in range(T - 2, -1, -1):
            b = self.step[None] + (emit[:, t + 1] + beta[:, t + 1])[:, None, :]
            new = np.logaddexp(b[..., 0], b[..., 1])
            beta[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        p = np.exp(alpha[..., 1] + beta[..., 1] - z[:, None]) * mask
        if not want_pairs:
            return p
        pairs = np.zeros((2, 2))
        for t in range(1, T):
            x = alpha[:, t - 1, :, None] + self.step[None] + (emit[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
            pairs += (np.exp(x) * mask[:, t, None, None]).sum(0)
        return p, pairs

    def train(self, seqs: list[tuple[list[int], list[int]]], epochs: int = 10, batch: int = 96, rate: float = 0.35, decay: float = 2e-5, seed: int = 5) -> Tagger:
        rng = np.random.default_rng(seed)
        g2 = np.full(1 << BITS, 1e-2, dtype=np.float32)
        s2 = np.full((2, 2), 1.0)
        for _ in range(epochs):
            order = rng.permutation(len(seqs))
            for at in range(0, len(order), batch):
                part = [seqs[i] for i in order[at : at + batch]]
                T = max(len(h) for h, _ in part)
                h = np.zeros((len(part), T), dtype=np.uint64)
                y = np.zeros((len(part), T))
                mask = np.zeros((len(part), T), dtype=bool)
                for i, (hs, ys) in enumerate(part):
                    h[i, : len(hs)] = hs
                    y[i, : len(ys)] = ys
                    mask[i, : len(hs)] = True
                f = features(h)
                p, pairs = self.marginals(f, mask, want_pairs=True)
                diff = (y - p) * mask
                used, where = np.unique(f[mask].ravel(), return_inverse=True)
                grad = np.bincount(where, weights=np.repeat(diff[mask], f.shape[-1]))
                g2[used] += grad**2
                self.w[used] += rate * grad / np.sqrt(g2[used])
                self.w[used] *= 1 - decay * 50
                seen = np.zeros((2, 2))
                for hs, ys in part:
                    for a, b in zip(ys[:-1], ys[1:], strict=True):
                        seen[a, b] += 1
                ds = seen - pairs
                s2 += ds**2
                self.step += rate * ds / np.sqrt(s2)
        self.w[np.abs(self.w) < LEAST_WEIGHT] = 0.0
        return self


_SLOT = re.compile(r"\{(\w+)\}")
_LISTS = {k: [x.strip() for x in v.split("|")] for k, v in {**SLOTS, **toxic_more.SLOTS}.items()}


def _disguised(word: str, r: random.Random) -> str:
    kind = r.randrange(4)
    if kind == 0:
        return "".join({"o": "0", "i": "1", "e": "3", "a": "@", "s": "$"}.get(c, c) if r.random() < 0.6 else c for c in word)
    if kind == 1 and len(word) > 3:
        return word[0] + "*" * (len(word) - 2) + word[-1]
    if kind == 2:
        return ".".join(word) if len(word) < 7 else word
    i = r.randrange(len(word))
    return word[:i] + word[i] * 3 + word[i + 1 :]


def examples(seed: int = 3, per_line: int = 12) -> list[tuple[list[int], list[int]]]:
    """Sequences of word hashes and labels; abusive and harmless sentences are also strung together."""
    r = random.Random(seed)

    def fill(line: str) -> str:
        return _SLOT.sub(lambda m: r.choice(_LISTS[m.group(1)]), line)

    def labelled(line: str) -> list[tuple[str, int]]:
        out = []
        for i, part in enumerate(re.split(r"[«»]", fill(line))):
            # the marks alternate; quotation marks of the sentences are others
            for w, _, _ in tokens(part):
                if i % 2 and r.random() < 0.06 and len(w) > 3 and w.isascii():
                    w = _disguised(w, r)
                out.append((plain(w), i % 2))
        return out

    bad = [x for x in (ABUSIVE + toxic_more.ABUSIVE).split("\n") if x.strip()]
    bad += 2 * [x for x in bad if re.search(r"\{(?:insult|rude|folk|de|fr|es|pt|ru|it|zh|ja)\}", x)]  # their slots have many fillings
    good = [x.replace("«", '"').replace("»", '"') for x in (HARMLESS + toxic_more.HARMLESS).split("\n") if x.strip()]
    seqs = []
    for _ in range(per_line):
        for line in [*bad, *good, *good]:
            words = labelled(line)
            if r.random() < 0.35:
                more = labelled(r.choice(good))
                words = more + words if r.random() < 0.5 else words + more
            seqs.append(([word_hash(w) for w, _ in words][:SEQUENCE], [y for _, y in words][:SEQUENCE]))
    # common words in any order among unknown ones are harmless, too
    common = sorted({w for line in good for w, _ in labelled(line)})
    for _ in range(per_line * len(good) // 2):
        words = [r.choice(common) if r.random() < 0.7 else f"\0{r.randrange(10**6)}" for _ in range(r.randint(3, 18))]
        seqs.append(([word_hash(w) for w in words], [0] * len(words)))
    return seqs


_tagger: list[Tagger] = []


def tagger() -> Tagger:
    if not _tagger:
        _tagger.append(Tagger().train(examples()))
    return _tagger[0]


class Scorer:
    """Batch scoring with remembered word hashes."""

    def __init__(self, model: Tagger) -> None:
        self.model = model
        self.hashes: dict[str, int] = {}
        self.seen: dict[str, list[tuple[int, int, float]]] = {}

    def _hash(self, w: str) -> int:
        h = self.hashes.get(w)
        if h is None:
            if len(self.hashes) > 300_000:
                self.hashes.clear()
            h = self.hashes[w] = word_hash(plain(w))
        return h

    def score(self, texts: list[str]) -> list[tuple[float, list[tuple[int, int, float]]]]:
        """Per text: (score, spans of (start, end, mean probability))."""
        places = [_sentences(t) for t in texts]
        self.learn({t[a:b] for t, p in zip(texts, places, strict=True) for a, b in p})
        out = []
        for t, p in zip(texts, places, strict=True):
            spans = [(a + x, a + y, q) for a, b in p for x, y, q in self.seen[t[a:b]]]
            out.append((1.0 - float(np.prod([1.0 - q for _, _, q in spans])) if spans else 0.0, spans))
        return out

    def learn(self, sentences: set[str]) -> None:
        """Spans of sentences not met before; menus and notices come back on page after page."""
        if len(self.seen) > 200_000:
            self.seen.clear()
        new = [s for s in sentences if s not in self.seen]
        seqs = [tokens(s) for s in new]
        for s in new:
            self.seen[s] = []
        order = sorted(range(len(seqs)), key=lambda k: len(seqs[k]))
        at = 0
        while at < len(order):  # whole sentences; a batch has CELLS places at most, or one sentence
            to = at + 1
            while to < len(order) and (to + 1 - at) * len(seqs[order[to]]) <= CELLS and to - at < 2048:
                to += 1
            part = order[at:to]
            at = to
            T = len(seqs[part[-1]])
            if not T:
                continue
            h = np.zeros((len(part), T), dtype=np.uint64)
            mask = np.zeros((len(part), T), dtype=bool)
            for i, k in enumerate(part):
                s = seqs[k]
                h[i, : len(s)] = [self._hash(w) for w, _, _ in s]
                mask[i, : len(s)] = True
            p = self.model.marginals(features(h), mask)
            for i in np.flatnonzero(p.max(1) > WORD_P):
                k = part[i]
                self.seen[new[k]] = _runs(p[i], seqs[k])


def _sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the pieces between sentence ends."""
    out, at = [], 0
    for m in _BREAK.finditer(text):
        if m.end() > at:
            out.append((at, m.end()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def _runs(p: np.ndarray, words: list[tuple[str, int, int]]) -> list[tuple[int, int, float]]:
    """Runs of likely words whose probabilities sum to SPAN_SCORE at least, or one near-certain word that is a sentence."""
    out = []
    i, n = 0, len(words)
    while i < n:
        if p[i] <= WORD_P:
            i += 1
            continue
        k = i
        while k < n and p[k] > WORD_P:
            k += 1
        if p[i:k].sum() >= SPAN_SCORE or (n <= 2 and p[i:k].max() > 0.9):
            out.append((words[i][1], words[k - 1][2], float(p[i:k].mean())))
        i = k
    return out


def page_text(html: str) -> str:
    return "\n\n".join(b.text for b in blocks(html))


_scorer: list[Scorer] = []


def scored(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """(tbl, rec_id, source, score, spans) for every page and comment, null texts included.

    Offsets of comments are those of the text, of pages those of their visible text.
    """
    p = pages.select(F.lit("pages").alias("tbl"), F.col("page_id").alias("rec_id"), "source", F.col("html").alias("text"))
    c = comments.select(F.lit("comments").alias("tbl"), F.col("comment_id").alias("rec_id"), "source", "text")
    model = p.sparkSession.sparkContext.broadcast(tagger())  # fixed size: 2^BITS weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not _scorer:
            _scorer.append(Scorer(model.value))
        for pdf in batches:
            texts = []
            for tbl, t in zip(pdf["tbl"], pdf["text"], strict=True):
                t = t if isinstance(t, str) else ""
                texts.append(page_text(t) if tbl == "pages" else t)
            got = _scorer[0].score(texts)
            yield pd.DataFrame(
                {
                    "tbl": pdf["tbl"], "rec_id": pdf["rec_id"], "source": pdf["source"], "score": [g[0] for g in got],
                    "spans": [[{"start_pos": a, "end_pos": b, "p": q} for a, b, q in g[1]] for g in got],
                }
            )

    rows = spread(p.unionByName(c), "rec_id")
    return rows.mapInPandas(run, "tbl string, rec_id bigint, source string, score double, spans array<struct<start_pos:int,end_pos:int,p:double>>")


def found(pages: DataFrame, comments: DataFrame) -> DataFrame:
    return scored(pages, comments).where(F.col("score") >= DOCUMENT_SCORE).select("tbl", "rec_id")


def rates(pages: DataFrame, comments: DataFrame) -> DataFrame:
    """(tbl, source, n, n_toxic, rate) per table and source; a null source is the source ''."""
    return (
        scored(pages, comments).groupBy("tbl", F.coalesce(F.lower(F.trim("source")), F.lit("")).alias("source"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") >= DOCUMENT_SCORE).alias("n_toxic"))
        .withColumn("rate", F.col("n_toxic") / F.col("n"))
    )
