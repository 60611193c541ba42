"""3. Toxicity behind obfuscation: a noisy channel decoded by Viterbi search, then a score of the restored text.

Source model: a character 4-gram model of words, counted over all documents. Channel: a letter may be written as a
look-alike digit or symbol, may be repeated, and may be followed by separators or spaces. A lattice holds every
reading of a written span; Viterbi search finds the likeliest, and the restored words are scored by weights fitted to
labelled documents.

Only readings that end in a weighted word can change a score, so spans that can't be read as one are never decoded;
every span that can be is decoded, with all readings (the search has no beam), so the score is that of the whole text
restored. The test is exact: look-alikes share a class, separators vanish, runs collapse, and what is left of a span
must equal what is left of some weighted word; symbols that may also stand for nothing are tried both ways, along a
trie of the weighted words, from those beginnings of words only that agree with the trie up to the symbol. A symbol
with ``NOISE`` symbols directly before it is never noise. Spans begin and end where words do. Features of which fewer than
``SHORTEST`` classes are left (``kill``, other scripts) are whole words only and are found as they are written, accents
folded, without the channel.

Fit: at most ``TRAIN_ROWS`` labelled documents (by hashed doc_id). Features are beginnings of words and whole words
(marked by ``$``). A feature's evidence is its number of distinct contexts (word before, word, word after) in toxic and
in other documents, so that copies count once; features are taken greedily by weight of evidence, none that begins
another. A document of n words is scored by the ratio of two Poisson laws for the number of distinct words with the
feature: n times the rate in other documents, against that plus the usual number in toxic documents that have it.

Defined results: a null or empty text has score null or the prior, no words and is_toxic = false; ties of readings go
to the first in code order; repeated rows give repeated rows; labels that are null, or of unknown documents, don't
train, and a doc_id with several labels counts as toxic if one says so; without labels nothing is toxic; other columns
are ignored by ``score`` and pass through ``reject``; an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import tokens, util

TRAIN_ROWS = 20_000
MIN_CONTEXTS = 6  #: distinct toxic contexts a feature needs
MIN_LOG_ODDS = 2.0
MIN_EVIDENCE = 15.0
THRESHOLD = 0.95
LONGEST = 10  #: letters of the longest beginning
SHORTEST = 4  #: classes that a feature needs for the channel
NOISE = 3  #: symbols in a row that may stand for nothing
BLOCK = 1 << 18  #: bytes that are looked at together, so that a worker holds little

#: What each written symbol may stand for, besides itself.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c"}
_FOLD = {"à": "a", "á": "a", "â": "a", "ã": "a", "ä": "a", "å": "a", "ç": "c", "è": "e", "é": "e", "ê": "e", "ë": "e", "ì": "i", "í": "i", "î": "i", "ï": "i", "ñ": "n", "ò": "o", "ó": "o", "ô": "o", "õ": "o", "ö": "o", "ù": "u", "ú": "u", "û": "u", "ü": "u", "ý": "y", "ÿ": "y"}
_CLASS = {c: c for c in "abcdefghijklmnopqrstuvwxyz"} | {"l": "i", "z": "s"}
_SYMBOL_CLASS = {s: _CLASS[o[0]] for s, o in LOOKS.items()}
_BLANK = (9, 10, 11, 12, 13, 32)

# byte tables: class of a byte (0: vanishes), whether it is a letter or digit
_BYTE = np.zeros(256, np.uint8)
for _c, _k in (_CLASS | _SYMBOL_CLASS).items():
    _BYTE[ord(_c)] = ord(_k)
for _c, _k in _FOLD.items():
    _BYTE[_c.encode()[1]] = ord(_CLASS[_k])  # all have the lead byte C3, which vanishes
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(_BLANK)] = True


def _letters(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to letters or digits, as in ``_words``, and which end a character with the lead byte C3."""
    word = _ALNUM[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    latin = np.zeros(len(raw), bool)
    if len(lead):
        latin[np.minimum(lead[raw[lead] == 0xC3] + 1, len(raw) - 1)] = True
        size = 2 + (raw[lead] >= 0xE0) + (raw[lead] >= 0xF0).astype(np.int64)
        code = raw[lead].astype(np.int64) & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            code[more] = code[more] << 6 | raw[np.minimum(lead[more] + k, len(raw) - 1)] & 0x3F
        one, at = np.unique(code, return_inverse=True)
        alnum = np.array([c < 0x110000 and chr(c).isalnum() for c in one.tolist()])[at]
        for k in range(4):
            x = lead[alnum & (size > k)] + k
            word[x[x < len(raw)]] = True
    return word, latin


def skeleton(word: str) -> str:
    """What is left of a word: classes of look-alikes, without separators, runs collapsed."""
    out: list[str] = []
    for c in word.lower():
        k = _CLASS.get(_FOLD.get(c, c)) or _SYMBOL_CLASS.get(c)
        if k and (not out or out[-1] != k):
            out.append(k)
    return "".join(out)


class CharModel:
    """Interpolated 4-gram model over 28 symbols: 0 the word's edge, 1 to 26 letters, 27 anything else."""

    ORDER, SIZE = 4, 28

    def __init__(self, counts: np.ndarray) -> None:
        c4 = counts.reshape((self.SIZE,) * 4).astype(np.float64)
        p = (c4.sum((0, 1, 2)) + 1) / (c4.sum() + self.SIZE)
        for axes in ((0, 1), (0,), ()):
            c = c4.sum(axes) if axes else c4
            n = c.sum(-1, keepdims=True)
            distinct = np.maximum((c > 0).sum(-1, keepdims=True), 1)
            p = (c + distinct * p) / (n + distinct)  # Witten-Bell
        self.logp = np.log(p)

    @staticmethod
    def symbol(c: str) -> int:
        c = _FOLD.get(c, c)
        return ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27


_SYM = np.full(256, 27, np.uint8)
_SYM[97:123] = np.arange(1, 27)
for _c, _k in _FOLD.items():
    _SYM[_c.encode()[1]] = ord(_k) - 96


@tokens.tidy
def _count_chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """4-gram counts of words (letters only; everything else is an edge) of the partition."""
    n = CharModel.SIZE
    total = np.zeros(n**4, np.int64)
    for whole in batches:
        for batch in tokens.cut(whole):
            for _, _, raw, off in tokens.blocks(tokens.lowered(batch.column(0)), BLOCK):
                word, latin = _letters(raw)
                sym = np.where(word & ~((raw >= 48) & (raw < 58)), np.where((raw < 0x80) | latin, _SYM[raw], 27), 0).astype(np.uint8)
                keep = (raw != 0xC3) & ((raw < 0x80) | (raw >= 0xC0) | latin)  # one byte of each letter
                edge = np.zeros(len(raw) + 1, bool)
                edge[off] = True
                sym = np.where(edge[:-1] & ~keep, 0, sym)
                keep |= edge[:-1]
                s = sym[keep].astype(np.int32)
                s = np.concatenate([[0], s, [0]])
                again = np.append(True, (s[1:] != 0) | (s[:-1] != 0))
                s = s[again]
                pad = np.repeat(s, np.where(s == 0, 3, 1))  # three edges between words
                code = ((pad[:-3] * n + pad[1:-2]) * n + pad[2:-1]) * n + pad[3:]
                # a context may not reach over the edge into the word before
                over = ((pad[1:-2] == 0) & (pad[:-3] != 0)) | ((pad[2:-1] == 0) & (pad[1:-2] != 0))
                total += np.bincount(code[~over], minlength=n**4)
    at = np.flatnonzero(total)
    if len(at):
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["code", "n"])


def char_model(docs: DataFrame) -> CharModel:
    """Counted over all documents; the counts that reach the driver are at most 28**4, at any scale."""
    util.make_importable(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string").alias("text")).where("text is not null").mapInArrow(_count_chars, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CharModel.SIZE**4, np.int64)
    counts[rows["code"].to_numpy()] = rows["n"].to_numpy()
    return CharModel(counts)


#: Log costs of the channel: a look-alike, a letter that repeats the last, one more such, a separator within a word, a space within
#: one, a symbol that stands for
#: nothing, a word's end at a separator or among letters that stand apart.
LOOK, REPEAT, AGAIN, SEPARATOR, SPACE, NOTHING, BREAK = -1.5, -4.6, -0.5, -1.0, -2.0, -2.5, -3.0


def noisy(text: str, i: int) -> bool:
    """Whether ``NOISE`` look-alike symbols stand directly before a place."""
    return i >= NOISE and all(c in LOOKS and not c.isdigit() for c in text[i - NOISE : i])


def decode(span: str, model: CharModel) -> str:
    """The likeliest reading of a written span; words are separated by single spaces."""
    logp = model.logp
    #: (last three symbols, last character) -> (log probability, text so far)
    states: dict[tuple[int, int, int, str], tuple[float, str]] = {(0, 0, 0, ""): (0.0, "")}

    def emit(new: dict, state: tuple[int, int, int, str], text: str, lp: float, c: str) -> None:
        a, b, d, _ = state
        if c == " ":
            if not text or text[-1] == " ":
                nxt, val = state, (lp, text)
            else:
                nxt, val = (0, 0, 0, " "), (lp + float(logp[a, b, d, 0]), text + " ")
        else:
            s = CharModel.symbol(c)
            nxt, val = (b, d, s, c), (lp + float(logp[a, b, d, s]), text + c)
        stay(new, nxt, val)

    def stay(new: dict, state: tuple[int, int, int, str], val: tuple[float, str]) -> None:
        if state not in new or (-val[0], val[1]) < (-new[state][0], new[state][1]):
            new[state] = val

    low = span.lower()
    spaced = sum(len(w) == 1 for w in low.split()) >= 3
    for i, c in enumerate(low):
        new: dict[tuple[int, int, int, str], tuple[float, str]] = {}
        folded = _FOLD.get(c, c)
        # a letter spelled out after a separator is a new one
        apart = i == 0 or not (low[i - 1].isalnum() or low[i - 1] in LOOKS)
        repeat = -math.inf if apart else AGAIN if i > 1 and low[i - 1] == low[i - 2] == c else REPEAT
        for state, (lp, text) in states.items():
            last = text[-1:] if text and text[-1] != " " else ""
            if c.isspace():
                emit(new, state, text, lp + (BREAK if spaced else 0.0), " ")
                keep = (lp + (SPACE if not spaced else SEPARATOR * 0.2), text)
                if text:
                    stay(new, state, keep)
                continue
            if "a" <= folded <= "z":
                emit(new, state, text, lp, folded)
                if last == folded and repeat > -math.inf:
                    stay(new, state, (lp + repeat, text))
                continue
            for o in LOOKS.get(c, ""):
                emit(new, state, text, lp + LOOK, o)
                if last == o and repeat > -math.inf:
                    stay(new, state, (lp + repeat + LOOK, text))
            if c.isdigit() or c.isalpha():
                emit(new, state, text, lp + (LOOK if c.isdigit() else 0.0), c)
            else:  # a separator, or punctuation that ends the word
                cost = lp + (NOTHING if c in LOOKS else SEPARATOR)
                if c not in LOOKS or not noisy(low, i):
                    stay(new, state, (cost, text))
                emit(new, state, text, cost + BREAK, " ")
        states = new
    done = [(lp + float(logp[a, b, d, 0]) * bool(text.strip()), text) for (a, b, d, _), (lp, text) in states.items()]
    return min(done, key=lambda x: (-x[0], x[1]))[1].strip() if done else ""


def channelled(text: str) -> bool:
    """Whether a feature leaves enough for the gate; shorter ones and other scripts would match everywhere or nowhere."""
    return len(skeleton(text.rstrip("$"))) >= SHORTEST


class Feature:
    """A beginning, or with ``$`` a whole word; rate in other documents, share of toxic documents and usual number there."""

    def __init__(self, text: str, rate: float, share: float = 0.0, usual: float = 1.0) -> None:
        self.text, self.rate, self.share, self.usual = text, rate, share, usual
        self.exact = text.endswith("$") and not channelled(text)  #: found as it is written only

    def log_ratio(self, k: int, n_words: int) -> float:
        clean = max(n_words, 1) * self.rate
        x = k * math.log((clean + self.usual) / clean) - self.usual + math.log(max(self.share, 1e-9))
        rest = math.log(max(1 - self.share, 1e-9))
        return max(x, rest) + math.log1p(math.exp(-abs(x - rest)))


class Scanner:
    """Finds spans of a block that can be read as a word with a feature."""

    def __init__(self, features: list[Feature], bias: float, model: CharModel) -> None:
        self.features, self.bias, self.model = features, bias, model
        self.memo: dict[str, tuple[str, ...]] = {}
        by: dict[tuple[int, bool], set[int]] = {}
        for f in features:
            s = skeleton(f.text.rstrip("$"))
            if len(s) >= 2 and not f.exact:
                by.setdefault((len(s), f.text.endswith("$")), set()).add(self._hash(s))
        self.by = {n: np.array(sorted(v), np.uint64) for n, v in by.items()}
        #: trie of what is left of features: node -> (children by class, ends a whole word, ends a beginning)
        self.trie: list[tuple[dict[int, int], set[bool]]] = [({}, set())]
        starts: dict[int, set[int]] = {}
        for f in features:
            s = skeleton(f.text.rstrip("$"))
            if len(s) < 2 or f.exact:
                continue
            node = 0
            for i, c in enumerate(s.encode()):
                starts.setdefault(i + 1, set()).add(self._hash(s[: i + 1]))
                if c not in self.trie[node][0]:
                    self.trie.append(({}, set()))
                    self.trie[node][0][c] = len(self.trie) - 1
                node = self.trie[node][0][c]
            self.trie[node][1].add(f.text.endswith("$"))
        self.starts = {n: np.array(sorted(v), np.uint64) for n, v in starts.items()}
        self.channelled = [not f.exact for f in features]
        self.exact = np.array(sorted({self._hash(f.text[:-1]) for f in features if f.exact}), np.uint64)

    def matching(self, word: str) -> list[int]:
        return [i for i, f in enumerate(self.features) if (word + "$").startswith(f.text)]

    @staticmethod
    def _hash(s: str) -> int:
        h = 0
        for i, c in enumerate(s.encode()):
            h = (h + int(tokens._RND[c]) * pow(tokens._BASE, i, 1 << 64)) & tokens._M
        return h

    def spans(self, raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, first byte, end byte) of candidates. They begin and end where words do. Runs collapse within
        tokens; then within words, where that differs (``idiot-to``); then over tokens, where that differs (``t t``)."""
        if not len(raw) or not self.by:
            return
        word, latin = _letters(raw)
        kind = np.where((raw < 0x80) | latin, _BYTE[raw], 0)
        at = np.flatnonzero(kind)
        if not len(at):
            return
        space = _SPACE[raw]
        edge = np.zeros(len(raw) + 1, np.int32)
        np.add.at(edge, off[1:-1], 1)
        token = (np.cumsum(space, dtype=np.int32) + np.cumsum(edge[:-1], dtype=np.int32))[at]  # a document's start begins a token
        part = np.cumsum(np.append(False, word[1:] != word[:-1]), dtype=np.int32)[at]
        doc = np.searchsorted(off, at, "right") - 1
        k = kind[at]
        # no letter or digit of the document before the character, or after it
        prior = at - 1 - latin[at]
        free_before = (prior < off[doc]) | ~word[np.maximum(prior, 0)]
        after = at + 1
        free_after = (after >= off[doc + 1]) | ~word[np.minimum(after, len(raw) - 1)]
        stops, blanks = np.flatnonzero(~word & (kind == 0)), np.flatnonzero(space)

        def to_end(a: int, b: int, d: int) -> int:
            """The end of the word, or of the token where separators stand between the letters."""
            near = stops if np.searchsorted(stops, a) == np.searchsorted(stops, b) else blanks
            e = int(np.searchsorted(near, b))
            b = min(int(near[e]) if e < len(near) else len(raw), int(off[d + 1]))
            while not kind[b - 1] and not word[b - 1]:
                b -= 1
            return b

        yield from self._noise(at, k, ~word[at], doc, free_before, free_after, to_end)
        same = k[1:] == k[:-1]
        same_token = token[1:] == token[:-1]
        same_word = same_token & (part[1:] == part[:-1])
        passes = [(same & same_token, None)]
        for joined, differs in ((same & same_word, same & same_token & ~same_word), (same & (doc[1:] == doc[:-1]), same & ~same_token & (doc[1:] == doc[:-1]))):
            if differs.any():
                passes.append((joined, differs))
        for joined, differs in passes:
            new = np.append(True, ~joined)
            final = np.append(np.flatnonzero(new)[1:], len(at)) - 1  # last letter of each run
            first = np.flatnonzero(new)
            m = len(first)
            unlike = None
            if differs is not None:  # runs at a border where this pass differs from the first
                mark = np.zeros(len(at) + 1, np.int64)
                mark[1:-1] = np.cumsum(differs)
                mark[-1] = mark[-2]
                unlike = mark
            h = np.zeros(m + 1, np.uint64)
            np.cumsum(tokens._RND[k[first]] * tokens.powers(m), out=h[1:])
            inverse = tokens.powers(m, tokens._INV)
            start = np.flatnonzero(free_before[first])
            for (n, closed), known in self.by.items():
                s = start[start + n <= m]
                s = s[doc[first[s]] == doc[final[s + n - 1]]]
                if unlike is not None:
                    s = s[unlike[final[s + n - 1] + 1] > unlike[np.maximum(first[s] - 1, 0)]]
                if closed:
                    s = s[free_after[final[s + n - 1]]]
                got = (h[s + n] - h[s]) * inverse[s]
                i = np.minimum(np.searchsorted(known, got), len(known) - 1)
                for x in s[known[i] == got].tolist():
                    a, b, d = int(at[first[x]]), int(at[final[x + n - 1]]) + 1, int(doc[first[x]])
                    yield d, a, b if closed else to_end(a, b, d)

    def _noise(self, at: np.ndarray, k: np.ndarray, symbol: np.ndarray, doc: np.ndarray, free_before: np.ndarray, free_after: np.ndarray, to_end: Callable[[int, int, int], int]) -> Iterator[tuple[int, int, int]]:
        """Spans in which at least one symbol stands for nothing."""
        if not symbol.any():
            return
        n = len(at)
        first = np.append(True, k[1:] != k[:-1])
        run = np.cumsum(first) - 1
        m = int(run[-1]) + 1
        h = np.zeros(m + 1, np.uint64)
        np.cumsum(tokens._RND[k[first]] * tokens.powers(m), out=h[1:])
        places = np.flatnonzero(symbol)
        start = np.flatnonzero(free_before)
        upcoming = np.searchsorted(places, start, "right")
        start, upcoming = start[upcoming < len(places)], places[upcoming[upcoming < len(places)]]
        one = doc[start] == doc[upcoming]
        start, upcoming = start[one], upcoming[one]
        length = run[upcoming - 1] - run[start] + 1
        got = (h[run[upcoming - 1] + 1] - h[run[start]]) * tokens.powers(m, tokens._INV)[run[start]]
        near = at[1:] == at[:-1] + 1
        close = np.append(False, symbol[:-1] & near)  # directly after a symbol
        noise = symbol.copy()
        row = np.zeros(n, np.int64)
        for i in np.flatnonzero(close & symbol).tolist():
            row[i] = row[i - 1] + 1
        noise &= row < NOISE
        for size, known in self.starts.items():
            s = start[length == size]
            g = got[length == size]
            i = np.minimum(np.searchsorted(known, g), len(known) - 1)
            for x in s[known[i] == g].tolist():
                yield from self._walk(x, at, k, symbol, noise, doc, free_after, to_end)

    def _walk(self, x: int, at: np.ndarray, k: np.ndarray, symbol: np.ndarray, noise: np.ndarray, doc: np.ndarray, free_after: np.ndarray, to_end: Callable[[int, int, int], int]) -> Iterator[tuple[int, int, int]]:
        """Along the trie from one beginning of a word. A state is (node, class last taken, a symbol was left out)."""
        d = int(doc[x])
        if int(k[x]) not in self.trie[0][0]:
            return
        states = {(self.trie[0][0][int(k[x])], int(k[x]), False)}
        i = x
        while True:
            i += 1
            if i >= len(at) or doc[i] != d:
                return
            c, skip = int(k[i]), bool(noise[i])
            new = set()
            for node, last, left in states:
                if skip:
                    new.add((node, last, True))
                child = node if c == last else self.trie[node][0].get(c, -1)
                if child >= 0:
                    new.add((child, c, left))
            if not new:
                return
            for node, last, left in new:
                ends = self.trie[node][1]
                if left and ends and last == c:
                    a, b = int(at[x]), int(at[i]) + 1
                    if True in ends and free_after[i]:
                        yield d, a, b
                    if False in ends:
                        yield d, a, to_end(a, b, d)
            states = new

    def plain(self, raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, str]]:
        """(document, word) of words that are written like an exact feature, accents folded."""
        if not len(raw) or not len(self.exact):
            return
        word, latin = _letters(raw)
        folded = latin & (_SYM[raw] != 27)
        keep = np.append(~folded[1:], True)  # the lead byte of a folded letter goes
        byte = np.where(folded, _SYM[raw] + 96, raw)
        edge = np.zeros(len(raw) + 1, bool)
        edge[1:-1] = word[1:] != word[:-1]
        edge[off] = True
        cut = np.flatnonzero(edge)
        inside = word[np.minimum(cut[:-1], len(raw) - 1)]
        s, e = cut[:-1][inside], cut[1:][inside]
        place = np.concatenate([[0], np.cumsum(keep)])
        byte = byte[keep]
        h = np.zeros(len(byte) + 1, np.uint64)
        np.cumsum(tokens._RND[byte] * tokens.powers(len(byte)), out=h[1:])
        got = (h[place[e]] - h[place[s]]) * tokens.powers(len(byte), tokens._INV)[place[s]]
        hit = self.exact[np.minimum(np.searchsorted(self.exact, got), len(self.exact) - 1)] == got
        for a, b, d in zip(s[hit].tolist(), e[hit].tolist(), (np.searchsorted(off, s[hit], "right") - 1).tolist()):
            for w in _words(raw[a:b].tobytes().decode("utf-8", "ignore")):
                if any(not self.channelled[f] for f in self.matching(w)):
                    yield d, w

    def read(self, span: str) -> tuple[str, ...]:
        """Words with a feature of the likeliest reading."""
        got = self.memo.get(span)
        if got is None:
            if len(self.memo) > 50_000:
                self.memo.clear()
            got = self.memo[span] = tuple(sorted({w for w in decode(span, self.model).split() if any(self.channelled[f] for f in self.matching(w))}))
        return got

    def documents(self, text: pa.Array) -> tuple[list[float | None], list[list[str] | None]]:
        scores: list[float | None] = []
        found: list[list[str] | None] = []
        known = np.asarray(text.is_valid())
        for i, j, raw, off in tokens.blocks(text, BLOCK):
            hits: list[set[str]] = [set() for _ in range(j - i)]
            # words: begins of runs of other bytes than white space
            ink = ~_SPACE[raw]
            begin = ink & ~np.append(False, ink[:-1])
            begin[off[:-1][np.diff(off) > 0]] |= ink[off[:-1][np.diff(off) > 0]]
            total = np.concatenate([[0], np.cumsum(begin)])
            size = total[off[1:]] - total[off[:-1]]
            for d, a, b in self.spans(raw, off):
                # a lead byte before, so that the first letter is whole
                a -= a > off[d] and raw[a - 1] == 0xC3
                hits[d].update(self.read(bytes(raw[a:b]).decode("utf-8", "ignore")))
            for d, w in self.plain(raw, off):
                hits[d].add(w)
            for k, ws in zip(range(i, j), hits):
                count: dict[int, int] = {}
                for w in ws:
                    for f in self.matching(w):
                        count[f] = count.get(f, 0) + 1
                x = self.bias + sum(self.features[f].log_ratio(n, int(size[k - i])) for f, n in sorted(count.items()))
                scores.append(round(1 / (1 + math.exp(-max(-50.0, min(50.0, x)))), 6) if known[k] else None)
                found.append(sorted(ws) if known[k] else None)
        return scores, found


_fold_table = {ord(a): b for a, b in _FOLD.items()}


def _words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+", text.lower().translate(_fold_table))


_CONTEXT = 24  #: bits of a context's hash; the rest of 64 are the word's


@tokens.tidy
def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word, context) of each class as one number, and once for each word its text."""
    import xxhash

    names = ["key", "toxic", "word"]
    known: dict[str, int] = {}
    held: dict[bool, list[np.ndarray]] = {False: [], True: []}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for toxic, parts in held.items():
            if parts:
                k = np.unique(np.concatenate(parts)).view(np.int64)
                yield pa.record_batch([pa.array(k), pa.array(np.full(len(k), toxic)), pa.nulls(len(k), pa.string())], names=names)
            parts.clear()

    for whole in batches:
        for batch in tokens.cut(whole, 100):
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = _words(t)
                new = [w for w in set(ws) if w not in known]
                for w in new:
                    known[w] = xxhash.xxh64_intdigest(w.encode()) >> _CONTEXT
                if new:
                    yield pa.record_batch([pa.array(np.array([known[w] for w in new], np.int64)), pa.array([False] * len(new), pa.bool_()), pa.array(new, pa.string())], names=names)
                h = np.zeros(len(ws) + 2, np.uint64)
                h[1:-1] = [known[w] for w in ws]
                context = tokens.mix(h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[2:]) >> np.uint64(64 - _CONTEXT)
                held[y].append((h[1:-1] << np.uint64(_CONTEXT)) | context)
                size += len(ws)
            if size > 300_000:
                yield from flush()
                size = 0
            if len(known) > 100_000:
                known.clear()
    yield from flush()


def _select(rows: list) -> list[Feature]:
    """Greedy choice among (text, toxic contexts, rate, log odds); ties to the longer, then the first by name."""
    chosen: list[Feature] = []
    rows = [r for r in rows if channelled(r["text"]) or r["text"].endswith("$")]  # first, so that none blocks others and is lost
    for r in sorted(rows, key=lambda r: (-r["evidence"], -len(r["text"]), r["text"])):
        if not any(r["text"].startswith(f.text) or f.text.startswith(r["text"]) for f in chosen):
            chosen.append(Feature(r["text"], r["rate"]))
    return chosen


def _usual(features: list[Feature]):
    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(features, 0.0, None)
        for batch in batches:
            index, n = [], []
            for t in batch.column(0).to_pylist():
                count: dict[int, int] = {}
                for w in set(_words(t)):
                    for f in scanner.matching(w):
                        count[f] = count.get(f, 0) + 1
                index += list(count)
                n += list(count.values())
            yield pa.record_batch([pa.array(index, pa.int64()), pa.array(n, pa.int64())], names=["feature", "n"])

    return run


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[Feature], float]:
    """(features, bias) from at most ``train_rows`` labelled documents."""
    util.make_importable(docs.sparkSession)
    lab = labels.select(F.col("doc_id").try_cast(util.id_type(docs)).alias("doc_id"), (F.col("toxic") != 0).alias("toxic")).where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lab = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    text = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    train = util.saved(text.join(F.broadcast(lab), "doc_id").select("text", "toxic"), "training")  # at most train_rows labels
    size = train.agg(F.sum(F.col("toxic").cast("bigint")).alias("t"), F.count("*").alias("n")).first()
    n_toxic, n_clean = int(size["t"] or 0), int((size["n"] or 0) - (size["t"] or 0))
    if not n_toxic or not n_clean:
        return [], -10.0
    seen = train.mapInArrow(_contexts, "key bigint, toxic boolean, word string")
    pairs = seen.where("word is null").groupBy("key").agg(F.max("toxic").alias("toxic"))
    counts = pairs.groupBy(F.shiftrightunsigned("key", _CONTEXT).alias("id")).agg(F.sum(F.col("toxic").cast("bigint")).alias("t"), F.sum((~F.col("toxic")).cast("bigint")).alias("c"))
    texts = seen.where("word is not null").groupBy(F.col("key").alias("id")).agg(F.min("word").alias("word"))
    words = util.saved(counts.join(texts, "id"), "words")
    marked = F.concat("word", F.lit("$"))
    starts = F.transform(F.sequence(F.lit(2), F.least(F.length("word"), F.lit(LONGEST))), lambda k: F.substring("word", F.lit(1), k))
    text = F.explode(F.array_append(F.when(F.length("word") >= 2, starts).otherwise(F.array().cast("array<string>")), marked)).alias("text")
    by = words.select(text, "t", "c").groupBy("text").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    total = words.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    rate = (F.col("c") + 0.5) / F.lit(float(total["c"]) + 1.0)
    odds = F.log(F.col("t") / F.lit(float(total["t"]) + 1.0)) - F.log(rate)
    rows = by.where(F.col("t") >= MIN_CONTEXTS).select("text", rate.alias("rate"), odds.alias("odds"), (F.col("t") * odds).alias("evidence")).where((F.col("odds") >= MIN_LOG_ODDS) & (F.col("evidence") >= MIN_EVIDENCE)).collect()
    features = _select(rows)
    for r in train.where("toxic").select("text").mapInArrow(_usual(features), "feature bigint, n bigint").groupBy("feature").agg(F.count("*").alias("docs"), F.sum("n").alias("n")).collect():
        features[r["feature"]].share = r["docs"] / n_toxic
        features[r["feature"]].usual = r["n"] / r["docs"]
    return features, math.log(n_toxic / n_clean)


def _score(features: list[Feature], bias: float, logp: np.ndarray, threshold: float):
    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(features, bias, _model(logp))
        for whole in batches:
            for batch in tokens.cut(whole):
                scores, found = scanner.documents(tokens.lowered(batch.column(1)))
                toxic = [s is not None and bool(f) and s >= threshold for s, f in zip(scores, found)]
                yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.string())), pa.array(toxic, pa.bool_())], names=["doc_id", "score", "words", "is_toxic"])

    return run


def _model(logp: np.ndarray) -> CharModel:
    model = CharModel.__new__(CharModel)
    model.logp = logp
    return model


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (probability), words (restored words with a feature), is_toxic."""
    features, bias = fit(docs, labels, train_rows)
    logp = char_model(docs).logp.astype(np.float32)
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_score(features, bias, logp, threshold), f"doc_id {util.id_type(docs)}, score double, words array<string>, is_toxic boolean")


def reject(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, with all their columns; one pass, no join."""
    features, bias = fit(docs, labels, train_rows)
    logp = char_model(docs).logp.astype(np.float32)
    at = docs.columns.index("text")

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(features, bias, _model(logp))
        for whole in batches:
            for batch in tokens.cut(whole):
                scores, found = scanner.documents(tokens.lowered(batch.column(at).cast(pa.string())))
                toxic = [s is not None and bool(f) and s >= threshold for s, f in zip(scores, found)]
                yield batch.filter(pa.array([not x for x in toxic], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
