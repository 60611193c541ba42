"""4. Information-theoretic sanitisation of personal data.

Protected entities are written identifiers: e-mail, network addresses, phone, card, bank and social-security numbers,
keys and secrets. They are replaced by their kind. Numbers of cards and bank accounts need right check digits, and
phone numbers their usual marks or a word for calling before them (``genuine``). Beyond that a term may reveal an entity by keeping its company: with
N distinct texts, n(e), n(t) and n(t, e) of which have the entity, the term, and both, the term discloses
log2(n(t, e) N / (n(t) n(e))) of the -log2(n(e) / N) bits of the entity. All four count texts, so that copies cancel.
A term that discloses at least ``THRESHOLD`` of them is generalised to its first half and ``*`` where that, counted over
all words with the beginning both with the entity and without, stays below the threshold, and removed (``***``)
otherwise, in all documents. Entities
are judged by themselves and, in ``sanitise`` and ``sanitised``, by what they share with others (``units``): domain and
owner of an address, network, area or issuer of a number.

Support: ``MIN_SUPPORT`` texts with both, or as many unlike surroundings (``WINDOW`` words to each side) of the entity
that have the term; of an entity in two texts, both; of an entity in a single text, where company in the text proves
nothing, a term that stands in its surroundings and in no other text.

Defined results: a null text stays null with null counts, an empty one stays empty; repeated rows give repeated rows;
a null doc_id is no hindrance; an entity in every text reveals nothing; where entities overlap the first in text order
is taken, then the kind named first; other columns are ignored by ``sanitised`` and pass through ``sanitise``; an empty
table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import tokens, util

WINDOW = 10
THRESHOLD = 0.8
MIN_SUPPORT = 3
COPIED = 2_000_000  #: hashes of texts with copies that are broadcast; beyond that the texts are shuffled
OWN = 500_000  #: (text, word) pairs to replace that are broadcast; beyond that the texts are shuffled once
LONGEST = 64  #: bytes of a term that is generalised; longer ones are removed
MOST_BITS = 27  #: log2 of the bits of a sieve at most: 16 MB
SIEVE_HASHES = 5
KINDS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "SECRET": r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{20,}|xox[abp]-[A-Za-z0-9-]{10,}|[0-9a-fA-F]{32,64})\b",
    "IBAN": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "IP": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "SSN": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "CARD": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "PHONE": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<!\w)\+\d{8,14}(?!\d)",
}
_FIND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS.items()))
_WORD = re.compile("[\\u3000-\\ud7ff]|[0-9A-Za-z\\x80-\\u2fff\\ue000-\\U0010ffff]+")
_TAG_OR_WORD = re.compile("\\[(?:" + "|".join(KINDS) + ")\\]|" + _WORD.pattern)
_BYTES = re.compile(rb"[\xe3-\xed][\x80-\xbf]{2}|[0-9A-Za-z\x80-\xe2\xee-\xff]+")  #: a word of ``tokens.words``
#: Every identifier has a match of this; texts without one aren't searched.
_HINT = "[0-9@]|AKIA|gh[pousr]_|sk-|xox[abp]-|[a-fA-F]{32}"
_ONE = {k: re.compile(p) for k, p in KINDS.items()}
_CALL = re.compile(r"(?:tel|phone|call|fax|mobil|cell|whatsapp|contact|hotline|rufen|anruf|appel|llam|telef)[^\d]{0,24}$", re.IGNORECASE)


def luhn(value: str) -> bool:
    digits = [int(c) for c in reversed(value) if c.isdigit()]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def mod97(value: str) -> bool:
    bare = value.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def genuine(kind: str, value: str, before: str) -> bool:
    """Check digits of cards (and no book numbers) and bank accounts; a phone number has a plus or brackets, three,
    three and four digits between dashes or dots, or a word for calling before it."""
    if kind == "CARD":
        digits = re.sub(r"\D", "", value)
        return luhn(value) and not (len(digits) == 13 and digits[:3] in ("978", "979"))
    if kind == "IBAN":
        return mod97(value)
    if kind == "PHONE" and value[0] not in "+(":
        return bool(re.fullmatch(r"\d{3}([.-])\d{3}\1\d{4}", value) and not re.search(r"\d[ .-]?$", before)) or bool(_CALL.search(before))
    return True


def find(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the identifiers of a text, in its order. Where a written form isn't genuine the other kinds
    are tried at its place, then the places after it."""
    at = 0
    while m := _FIND.search(text, at):
        at, before = m.start(), text[max(0, m.start() - 32) : m.start()]
        for kind in [m.lastgroup, *(k for k in KINDS if k != m.lastgroup)]:
            one = m if kind == m.lastgroup else _ONE[kind].match(text, at)
            if one and genuine(kind, one.group(), before):
                yield kind, at, one.end()
                at = one.end()
                break
        else:
            at += 1
            if text[at - 1].isdigit():  # numbers that begin within this one aren't identifiers either
                while at < m.end() and text[at].isdigit():
                    at += 1


def hinted(text: Column) -> Column:
    """``_HINT`` as a column: plain searches first, which most texts with an identifier pass."""
    out = text.rlike("[0-9@]")
    for plain in ("sk-", "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xoxa-", "xoxb-", "xoxp-"):
        out = out | text.contains(plain)
    return out | text.rlike("[a-fA-F]{32}")


def entity_key(kind: str, value: str) -> str:
    return kind + ":" + (re.sub(r"\D", "", value) if kind in ("PHONE", "CARD", "SSN") else value.lower())


def hashes(ws: list[str]) -> np.ndarray:
    """The hash that ``tokens.words`` gives to each of some lower-case words."""
    raw = np.frombuffer(" ".join(ws).encode(), np.uint8)
    return tokens.words(raw, np.array([0, len(raw)]))[0]


def units(kind: str, value: str) -> list[str]:
    """What a written value is judged by: itself, and what it shares with others. The kind isn't among these: the tag
    that replaces the value tells it anyway."""
    key = entity_key(kind, value)
    what = key.partition(":")[2]
    if kind == "EMAIL":
        local, _, domain = what.rpartition("@")
        owner = re.sub(r"[^a-z]", "", local.partition("+")[0])
        return [key, f"EMAIL-DOMAIN:{domain}"] + [f"EMAIL-OWNER:{owner}"] * (len(owner) > 2)
    shared = {"IP": ("NET", what.rpartition(".")[0]), "CARD": ("ISSUER", what[:6]), "SSN": ("AREA", what[:3]), "PHONE": ("PREFIX", what[:-4]), "IBAN": ("BANK", what.replace(" ", "")[:8])}.get(kind)
    return [key, f"{kind}-{shared[0]}:{shared[1]}"] if shared else [key]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Every text that isn't null once; only texts that have copies are shuffled while these are few enough to broadcast."""
    text = docs.select(F.col("text").cast("string").alias("text")).where("text is not null").withColumn("h", F.xxhash64("text"))
    copied = util.saved(text.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "copied")
    copied = F.broadcast(copied) if copied.count() <= COPIED else copied
    several = util.saved(text.join(copied, "h", "left_semi").select("text").distinct(), "copies")
    return text.join(copied, "h", "left_anti").select("text").unionByName(several)


def _short(h: np.ndarray) -> np.ndarray:
    """Hashes as the 48-bit terms of ``tokens.terms``."""
    return (h >> np.uint64(16)).view(np.int64)


_MARKED = "bare string, units array<string>, near_unit array<string>, near_term array<bigint>, near_n array<bigint>"


@tokens.tidy
def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text with entities: the lower-case text without them, their units, and the terms within ``WINDOW`` words
    of each with the number of unlike surroundings that have them."""
    for whole in batches:
        for batch in tokens.cut(whole):
            bare, unit, values = [], [], []
            for t in batch.column(0).to_pylist():
                found = list(find(t))
                if found:
                    ends = [(0, 0), *((i, j) for _, i, j in found), (len(t), len(t))]
                    bare.append("\x01".join(t[i:j].replace("\x01", " ") for (_, i), (j, _) in zip(ends, ends[1:])))
                    values.append([entity_key(k, t[i:j]) for k, i, j in found])
                    unit.append(sorted({u for k, i, j in found for u in units(k, t[i:j])}))
            low = pc.utf8_lower(pa.array(bare, pa.string()))
            near: list[dict[tuple[str, str], int]] = []
            for t, keys in zip(low.to_pylist(), values):
                ws: list[str] = []
                place = []
                for part in t.split("\x01"):
                    ws += _WORD.findall(part)
                    place.append(len(ws))
                seen: set[tuple] = set()
                count: dict[tuple[str, str], int] = {}
                for key, p in zip(keys, place):
                    around = tuple(ws[max(0, p - WINDOW) : p + WINDOW])
                    if (key, around) not in seen:
                        seen.add((key, around))
                        for w in set(around):
                            count[key, w] = count.get((key, w), 0) + 1
                near.append(count)
            every = sorted({w for c in near for _, w in c})
            of = dict(zip(every, _short(hashes(every)).tolist())) if every else {}
            lists = [unit, [[e for e, _ in c] for c in near], [[of[w] for _, w in c] for c in near], [list(c.values()) for c in near]]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch([low, *(pa.array(x, pa.list_(k)) for x, k in zip(lists, kinds))], names=["bare", "units", "near_unit", "near_term", "near_n"])


@tokens.tidy
def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, term) once for each text that has both."""
    for whole in batches:
        for batch in tokens.cut(whole, 200):
            ids = batch.column(1).to_pylist()
            for i, j, raw, off in tokens.blocks(batch.column(0)):
                h, _, doc = tokens.words(raw, off)
                term, _, start = tokens.terms(h, doc, j - i)
                a, b = [], []
                for d in range(j - i):
                    u = np.array(ids[i + d], np.int64)
                    t = term[start[d] : start[d + 1]].view(np.int64)
                    a.append(np.repeat(u, len(t)))
                    b.append(np.tile(t, len(u)))
                yield pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["id", "term"])


@tokens.tidy
def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, number of texts that have it), summed over a part of the partition."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        t = np.concatenate([x for x, _ in held] or [np.zeros(0, np.uint64)])
        n = np.concatenate([x for _, x in held] or [np.zeros(0, np.int64)])
        held.clear()
        one, at = np.unique(t, return_inverse=True)
        return pa.record_batch([pa.array(one.view(np.int64)), pa.array(np.bincount(at, n, len(one)).astype(np.int64))], names=["term", "n"])

    for whole in batches:
        for batch in tokens.cut(whole):
            for i, j, raw, off in tokens.blocks(tokens.lowered(batch.column(0))):
                h, _, doc = tokens.words(raw, off)
                held.append(np.unique(tokens.terms(h, doc, j - i)[0], return_counts=True))
                size += len(held[-1][0])
            if size > 500_000:
                yield flush()
                size = 0
    yield flush()


@tokens.tidy
def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, word) of the words of each block."""
    for whole in batches:
        for batch in tokens.cut(whole):
            for _, _, raw, off in tokens.blocks(batch.column(0)):
                h, start, doc = tokens.words(raw, off)
                t, first = np.unique(_short(h), return_index=True)
                data, ends = raw.tobytes(), off[doc + 1]
                word = [_BYTES.match(data, start[k], ends[k]).group().decode("utf-8", "ignore") for k in first.tolist()]
                yield pa.record_batch([pa.array(t), pa.array(word, pa.string())], names=["term", "word"])


class Sieve:
    """A Bloom filter of 64-bit hashes with at most ``MOST_BITS`` bits, however many hashes it holds: with very many it
    lets more pass, which the exact join that always follows drops."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @staticmethod
    def places(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
        a = tokens.mix(h.copy())
        for j in range(SIEVE_HASHES):
            yield (a + np.uint64(j) * ((a >> np.uint64(32)) | np.uint64(1))) & np.uint64(size - 1)

    @staticmethod
    def of(table: DataFrame, column: str) -> Sieve:
        """Of a column of BIGINT hashes; at most MOST_BITS / 64 rows reach the driver."""
        n = table.count()
        size = 1 << min(MOST_BITS, max(16, math.ceil(math.log2(16 * n + 1))))

        @tokens.tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                for p in Sieve.places(h, size):
                    yield pa.record_batch([pa.array((p >> np.uint64(6)).view(np.int64)), pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))], names=["cell", "bit"])

        cells = table.select(F.col(column).cast("bigint")).mapInArrow(run, "cell bigint, bit bigint").groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
        bits = np.zeros(size >> 6, np.uint64)
        bits[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
        return Sieve(bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        alive = np.arange(len(h))
        for p in self.places(h, len(self.bits) << 6):
            at = p[alive]
            alive = alive[(self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)]
            if not len(alive):
                break
        out = np.zeros(len(h), bool)
        out[alive] = True
        return out


def _beginnings(sieve: Sieve, lengths: list[int], raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, length in bytes, hash) once each, of the beginnings of words that pass the sieve."""
    h, start, doc = tokens.words(raw, off)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(h):
        # each word of the block is looked up once; its place among these stands for the document
        _, first, word = np.unique(h, return_index=True, return_inverse=True)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(tokens._RND[raw] * tokens.powers(len(raw)), out=sums[1:])
        inside = np.concatenate([[0], np.cumsum(~tokens._WORD[raw])])
        s, end = start[first], off[doc[first] + 1]
        for n in lengths:
            long = np.flatnonzero(s + n <= end)
            long = long[inside[s[long] + n] == inside[s[long]]]
            b = s[long]
            g = tokens.mix((sums[b + n] - sums[b]) * tokens.powers(len(raw), tokens._INV)[b] ^ np.uint64(n))
            hit = sieve.has(g)
            which = np.full(len(first), -1)
            which[long[hit]] = np.flatnonzero(hit)
            which = which[word]
            has = which >= 0
            if has.any():
                value, code = np.unique(g, return_inverse=True)
                one = np.unique(doc[has] * len(value) + code[which[has]])
                out.append((one // len(value), np.full(len(one), n), value[one % len(value)]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))  # type: ignore[return-value]


def _frequency(sieve: Sieve, lengths: list[int]):
    """Number of texts that have a word with a beginning that passes the sieve, summed by blocks: (length, hash, n)."""

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.cut(whole):
                for _, _, raw, off in tokens.blocks(tokens.lowered(batch.column(0))):
                    _, n, g = _beginnings(sieve, lengths, raw, off)
                    if len(g):  # the length is part of the hash
                        one, first, count = np.unique(g, return_index=True, return_counts=True)
                        yield pa.record_batch([pa.array(n[first]), pa.array(one.view(np.int64)), pa.array(count)], names=["length", "hash", "n"])

    return run


def _together(sieve: Sieve, lengths: list[int]):
    """(unit, length, hash) once for each text that has the unit and a beginning that passes the sieve."""

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.cut(whole, 200):
                ids = batch.column(1).to_pylist()
                for i, _, raw, off in tokens.blocks(batch.column(0)):
                    d, n, g = _beginnings(sieve, lengths, raw, off)
                    size = np.array([len(ids[i + k]) for k in d.tolist()], np.int64)
                    if len(d):
                        unit = np.concatenate([np.array(ids[i + k], np.int64) for k in d.tolist()])
                        yield pa.record_batch([pa.array(unit), pa.array(np.repeat(n, size)), pa.array(np.repeat(g, size).view(np.int64))], names=["id", "length", "hash"])

    return run


@tokens.tidy
def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, word, length in bytes of its first half, hash of that); no beginning of words over ``LONGEST`` bytes."""
    for whole in batches:
        for batch in tokens.cut(whole):
            words = batch.column(1).to_pylist()
            half = [word[: (len(word) + 1) // 2].encode() if len(word.encode()) <= LONGEST else b"" for word in words]
            size = np.array([len(x) for x in half], np.int64)
            hashed = [0 if not x else int(tokens.beginnings(np.frombuffer(x, np.uint8), np.array([0, len(x)]), np.zeros(1, np.int64), np.zeros(1, np.int64), len(x))[0][0]) for x in half]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(size), pa.array(np.array(hashed, np.uint64).view(np.int64))], names=["term", "word", "length", "hash"])


def _disclosing(text: DataFrame, n_docs: int, threshold: float, min_support: int, shared: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entity, id, n_e, term, n_te, ratio) of what discloses enough, the term as a hash; the marked texts; those texts
    with entities of several texts: (bare, ids)."""
    marked = util.saved(text.where(hinted(F.col("text"))).mapInArrow(_marked, _MARKED).withColumn("key", F.monotonically_increasing_id()), "marked")
    n_e = marked.select(F.explode("units").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    if not shared:
        n_e = n_e.where(~F.col("entity").rlike("^[A-Z]+-"))
    n_e = util.saved(n_e.where(F.col("n_e") < n_docs).select(F.xxhash64("entity").alias("id"), "entity", "n_e"), "units")
    near = marked.select(F.explode(F.arrays_zip("near_unit", "near_term", "near_n")).alias("x")).groupBy(F.xxhash64("x.near_unit").alias("id"), F.col("x.near_term").alias("term")).agg(F.sum("x.near_n").alias("windows"))
    near = util.saved(near.join(n_e.where("n_e = 1").select("id", F.lit(True).alias("single")), "id", "left").where(F.col("single") | (F.col("windows") >= min_support)), "near")
    # entities of one text need no counting; of the others each text's list comes back by a join, at any size
    again = marked.select("key", F.explode("units").alias("entity")).select("key", F.xxhash64("entity").alias("id")).join(n_e.where("n_e > 1").select("id"), "id")
    several = util.saved(marked.select("key", "bare").join(again.groupBy("key").agg(F.collect_list("id").alias("ids")), "key").select("bare", "ids"), "several")
    pairs = several.mapInArrow(_pairs, "id bigint, term bigint").groupBy("id", "term").agg(F.count("*").alias("n_te"))
    pairs = pairs.join(n_e, "id").join(near.where("single is null").select("id", "term", "windows"), ["id", "term"], "left")
    pairs = pairs.where((F.col("n_te") >= F.least(F.lit(min_support), "n_e")) | F.col("windows").isNotNull()).select("entity", "id", "term", "n_e", "n_te", F.lit(False).alias("only"))
    one = near.where("single").join(n_e, "id").select("entity", "id", "term", "n_e", F.lit(1).cast("bigint").alias("n_te"), (F.col("windows") < min_support).alias("only"))
    n_t = text.mapInArrow(_document_frequency, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n_t"))
    both = util.saved(pairs.unionByName(one), "pairs").join(n_t, "term")
    ratio = _ratio("n_te", "n_t", n_docs)
    return util.saved(both.withColumn("ratio", ratio).where((F.col("ratio") >= threshold) & (~F.col("only") | (F.col("n_t") == 1))).drop("only", "n_t"), "disclosing"), marked, several


def _ratio(both: str, each: str, n_docs: int) -> Column:
    """Share of the entity's bits that something discloses: that in ``each`` texts, in ``both`` with the entity."""
    return F.round(F.log2(F.col(both) * F.lit(float(n_docs)) / (F.col(each) * F.col("n_e"))) / -F.log2(F.col("n_e") / F.lit(float(n_docs))), 9)


def disclosures(docs: DataFrame, threshold: float = THRESHOLD, min_support: int = MIN_SUPPORT, shared: bool = False) -> DataFrame:
    """term, entity, ratio, general_ratio of every pair that has support and discloses at least ``threshold``; with
    ``shared`` also for what entities share (``units``). general_ratio is that of the term's first half with all words
    that begin so, each counted with the entity and over all; null where the term has over ``LONGEST`` bytes."""
    util.make_importable(docs.sparkSession)
    text = distinct_texts(docs)
    n_docs = text.count()
    both, marked, several = _disclosing(text, n_docs, threshold, min_support, shared)
    words = marked.select("bare").mapInArrow(_spelled, "term bigint, word string").join(both.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.min("word").alias("word"))
    words = util.saved(words.mapInArrow(_halved, "term bigint, word string, length bigint, hash bigint"), "words")
    halves = words.where("length > 0")
    lengths = sorted(r["length"] for r in halves.select("length").distinct().collect())  # at most LONGEST
    sieve = Sieve.of(halves.select("hash").distinct(), "hash")
    wanted = halves.select("length", "hash").distinct()
    n_g = text.mapInArrow(_frequency(sieve, lengths), "length bigint, hash bigint, n bigint").groupBy("length", "hash").agg(F.sum("n").alias("n_g")).join(wanted, ["length", "hash"], "left_semi")
    asked = both.join(words, "term")
    n_ge = several.mapInArrow(_together(sieve, lengths), "id bigint, length bigint, hash bigint").groupBy("id", "length", "hash").agg(F.count("*").alias("n_ge")).join(asked.where("n_e > 1").select("id", "length", "hash").distinct(), ["id", "length", "hash"], "left_semi")
    out = asked.join(n_g, ["length", "hash"], "left").join(n_ge, ["id", "length", "hash"], "left").withColumn("n_ge", F.coalesce("n_ge", F.lit(1)))
    return out.select(F.col("word").alias("term"), "entity", "ratio", _ratio("n_ge", "n_g", n_docs).alias("general_ratio"))


def replacements(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """term, replacement: the first half where that discloses too little of every entity that the term reveals."""
    by = found.groupBy("term").agg(F.max(F.coalesce("general_ratio", F.lit(1.0))).alias("g"))
    half = F.expr("substring(term, 1, cast((length(term) + 1) div 2 as int))")
    return by.select("term", F.when((F.col("g") < threshold) & (F.length("term") > 1), F.concat(half, F.lit("*"))).otherwise(F.lit("***")).alias("replacement"))


def clean_entities(text: str) -> tuple[str, int]:
    out, at, n = [], 0, 0
    for kind, i, j in find(text):
        out += [text[at:i], f"[{kind}]"]
        at, n = j, n + 1
    return "".join([*out, text[at:]]), n


def _candidates(sieve: Sieve):
    """(key, word) of the distinct words of each text that pass the sieve."""

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.cut(whole):
                key = batch.column(0)
                for i, j, raw, off in tokens.blocks(tokens.lowered(batch.column(1))):
                    h, start, doc = tokens.words(raw, off)
                    value, code = np.unique(h, return_inverse=True)
                    at = np.flatnonzero(sieve.has(value)[code])
                    if not len(at):
                        continue
                    _, first = np.unique(doc[at] * len(value) + code[at], return_index=True)
                    at = at[first]
                    data = raw.tobytes()
                    word = [_BYTES.match(data, int(start[k]), int(off[doc[k] + 1])).group().decode("utf-8", "ignore") for k in at.tolist()]
                    yield pa.record_batch([key.slice(i, j - i).take(pa.array(doc[at])), pa.array(word, pa.string())], names=["key", "word"])

    return run


@tokens.tidy
def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([pa.array(hashes(batch.column(0).to_pylist()).view(np.int64))], names=["hash"])


def replaced(text: str, terms: dict[str, str]) -> tuple[str, int]:
    n = 0

    def word(m: re.Match) -> str:
        nonlocal n
        new = terms.get(m.group().lower())
        n += new is not None
        return m.group() if new is None else new

    return _TAG_OR_WORD.sub(word, text), n


def _clean(text: pa.Array, terms: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(clean texts, entities, terms replaced) of texts with the replacements that each needs."""
    text = text.cast(pa.string())
    n_entities, n_terms = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    new: dict[int, str] = {}
    for i in np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring_regex(text, _HINT), False))).tolist():
        got, n = clean_entities(text[i].as_py())
        if n:
            new[i], n_entities[i] = got, n
    for i in np.flatnonzero(np.asarray(pc.and_(terms.is_valid(), text.is_valid()))).tolist():
        own = {x["word"]: x["replacement"] for x in terms[i].as_py()}
        got, n = replaced(new[i] if i in new else text[i].as_py(), own)
        if n:
            new[i], n_terms[i] = got, n
    if new:
        mask = np.zeros(len(text), bool)
        mask[list(new)] = True
        text = pc.replace_with_mask(text, pa.array(mask), pa.array([new[i] for i in sorted(new)], pa.string()))
    return text, n_entities, n_terms


def _with_terms(docs: DataFrame, threshold: float, min_support: int, key: str, terms: str) -> DataFrame:
    """``docs`` and in ``terms`` the replacements that a text needs, null where it needs none. The dictionary never
    leaves the executors: candidates that pass a sieve of bounded size are joined with it, and come back by the text's
    hash; texts that share a hash get what either needs, which changes neither."""
    found = util.saved(replacements(disclosures(docs, threshold, min_support, shared=True), threshold), "replacements")
    sieve = Sieve.of(found.select("term").mapInArrow(_hashed, "hash bigint"), "hash")
    keyed = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    text = keyed.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text")).where("text is not null")
    own = text.mapInArrow(_candidates(sieve), "key bigint, word string").distinct().join(found, F.col("word") == F.col("term"))
    own = util.saved(own.groupBy("key").agg(F.collect_list(F.struct("word", "replacement")).alias(terms)).withColumnRenamed("key", key), "own")
    n_pairs = own.agg(F.sum(F.size(terms))).first()[0] or 0
    return keyed.join(F.broadcast(own) if n_pairs <= OWN else own, key, "left")


def sanitised(docs: DataFrame, threshold: float = THRESHOLD, min_support: int = MIN_SUPPORT) -> DataFrame:
    """doc_id, text (sanitised), n_entities, n_terms of every document."""
    util.make_importable(docs.sparkSession)
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.cut(whole):
                text, a, b = _clean(batch.column(1), batch.column(2))
                mask = ~np.asarray(text.is_valid())
                yield pa.record_batch([batch.column(0), text, pa.array(a, mask=mask), pa.array(b, mask=mask)], names=["doc_id", "text", "n_entities", "n_terms"])

    return _with_terms(slim, threshold, min_support, "key", "terms").select("doc_id", "text", "terms").mapInArrow(run, f"doc_id {util.id_type(docs)}, text string, n_entities bigint, n_terms bigint")


def sanitise(docs: DataFrame, threshold: float = THRESHOLD, min_support: int = MIN_SUPPORT) -> DataFrame:
    """``docs`` with sanitised text; ``n_chars``, where it is there and isn't null, follows the text."""
    util.make_importable(docs.sparkSession)
    at = docs.columns.index("text")
    key, terms = util.fresh(docs, "pii_key", "pii_terms")
    out = docs.withColumn("text", F.col("text").cast("string"))
    schema = out.schema

    @tokens.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.cut(whole):
                text, _, _ = _clean(batch.column(at), batch.column(batch.num_columns - 1))
                kept = batch.schema.remove(batch.num_columns - 1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], text, *batch.columns[at + 1 : -1]], schema=kept.set(at, pa.field(kept.names[at], pa.string())))

    out = _with_terms(out, threshold, min_support, key, terms).select(*[F.col(f"`{c}`") for c in docs.columns], terms).mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull() & F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out
