"""Operators against brute force, plain encoders, held-out labels and SQL."""

import gzip
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.llm import bpe, fingerprints, lm, mixing, neardup, pii, queries, tokens, toxicity, warc

SMALL = "/root/testdata/sf0.001"
WORDS = "river stone market window garden letter summer winter bridge silver copper ladder engine market harbor candle meadow orchard".split()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(name, same_as_sql):
    same_as_sql(queries.queries()[name], queries.oracle_sql()[name])


def texts(n, seed=0, size=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(size)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_fingerprint_collisions_estimate_weighted_jaccard(spark):
    rng = random.Random(1)
    base = texts(12, 3)
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        w = t.split()
        rows.append((100 + i, " ".join(w[: rng.randrange(10, 60)] + w[:20])))
    got = {r["doc_id"]: np.array(r["signature"]) for r in fingerprints.fingerprints(frame(spark, rows), samples=512).collect()}
    bags = {i: Counter(t.split()) for i, t in rows}
    errors = []
    for i in range(12):
        for j in (100 + i, 100 + (i + 1) % 12):
            a, b = bags[i], bags[j]
            true = sum((a & b).values()) / sum((a | b).values())
            errors.append(float((got[i] == got[j]).mean()) - true)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.09


def brute_components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("distance,chunks", [(23, 12), (7, 8), (16, 8)])
def test_hamming_join_finds_every_pair(spark, distance, chunks):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2, (40, 256), dtype=np.uint8)
    rows = []
    for b in base:
        for k in (0, 1, 4, 5, 6, 7, 8, 20, 23, 24, 30):
            x = b.copy()
            x[rng.choice(256, k, replace=False)] ^= 1
            rows.append(x)
    bits = np.array(rows)
    sigs = [np.packbits(x).tobytes() for x in bits]
    df = spark.createDataFrame([(i, bytearray(s)) for i, s in enumerate(sigs)], "rep bigint, sig binary")
    want = {(i, j, int(d)) for i in range(len(bits)) for j in range(i + 1, len(bits)) if (d := (bits[i] != bits[j]).sum()) <= distance}
    got = [tuple(r) for r in neardup.hamming_pairs(df, distance, chunks).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    some = [(r["a"], r["b"]) for r in neardup.hamming_pairs(df, distance, chunks, every=False).collect()]
    assert brute_components(len(bits), some) == brute_components(len(bits), [x[:2] for x in want])


def test_chunks_too_few_to_pack_are_refused(spark):
    with pytest.raises(ValueError):
        neardup.hamming_pairs(spark.createDataFrame([], "rep bigint, sig binary"), 5, 2)


def test_near_duplicate_groups_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for t in texts(30, 4, 120):
        for k in (0, 0, 2, 6, 60):
            w = t.split()
            for p in rng.sample(range(len(w)), k):
                w[p] = "changed" + str(rng.randrange(10**6))
            rows.append((len(rows), " ".join(w)))
    df = frame(spark, rows)
    sig = {r["doc_id"]: np.frombuffer(bytes(r["sig"]), np.uint64) for r in neardup.signatures(df).collect()}
    near = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if np.bitwise_count(sig[i] ^ sig[j]).sum() <= neardup.DISTANCE]
    root = brute_components(len(rows), near)
    size = Counter(root)
    want = {(i, r) for i, r in enumerate(root) if size[r] > 1}
    assert {tuple(r) for r in neardup.groups(df).collect()} == want
    assert {r[0] for r in neardup.deduplicate(df).select("doc_id").collect()} == set(root)


def test_linking_of_heavy_buckets_keeps_components():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2, (3, 256), dtype=np.uint8)
    bits = np.array([np.where(rng.random(256) < 0.03, 1 - base[i % 3], base[i % 3]) for i in range(150)])
    sig = np.packbits(bits, axis=1).view(np.uint64)
    near = [(i, j) for i in range(150) for j in range(i + 1, 150) if (bits[i] != bits[j]).sum() <= 14]
    i, j = neardup.link_all(sig, 14)
    assert brute_components(150, list(zip(i.tolist(), j.tolist()))) == brute_components(150, near)


def test_viterbi_restores_obfuscated_words(spark):
    docs = frame(spark, [(i, t) for i, t in enumerate([" ".join(random.Random(i).choices(WORDS, k=200)) for i in range(40)])])
    model = toxicity.char_model(docs)
    for written, meant in (("r1v3r", "river"), ("rriiivver", "river"), ("m.e.a.d.o.w", "meadow"), ("c@ndl3", "candle"), ("s-t-o-n-e", "stone"), ("river", "river"), ("l e t t e r", "letter")):
        assert toxicity.decode(written, model) == meant, written


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    labels = labels.where("toxic is not null")
    score = toxicity.score(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").select("toxic", F.col("is_toxic").cast("int").alias("p")).collect()
    hit = sum(r["toxic"] and r["p"] for r in score)
    assert hit / max(sum(r["p"] for r in score), 1) >= 0.95
    assert hit / max(sum(r["toxic"] for r in score), 1) >= 0.8


def test_disclosures_equal_brute_force(spark):
    rng = random.Random(6)
    docs = []
    for i in range(120):
        w = [rng.choice(WORDS) for _ in range(rng.randrange(5, 40))]
        if i % 10 == 0:
            at = rng.randrange(len(w))
            w[at:at] = ["zanzibarian", "quaestor", "anna.k@example.org"]
        docs.append(" ".join(w))
    docs.append("mail anna.k@example.org")
    found = {(r["term"], r["entity"]): (r["ratio"], r["general_ratio"]) for r in pii.disclosures(frame(spark, list(enumerate(docs)))).collect()}
    n, near, n_e = len(docs), defaultdict(set), 0
    for t in docs:
        w = t.split()
        if "anna.k@example.org" in w:
            n_e += 1
            p = w.index("anna.k@example.org")
            rest = w[:p] + w[p + 1 :]
            around = rest[max(0, p - pii.WINDOW) : p + pii.WINDOW]
            for x in set(around):
                near[x].add(tuple(around))
    want = {}
    for x, windows in near.items():
        if len(windows) >= pii.MIN_SUPPORT:
            bits = -math.log2(n_e / n)
            ratio = lambda k: math.log2(len(windows) * n / (k * n_e)) / bits  # noqa: B023, E731
            r = ratio(sum(x in t.split() for t in docs))
            half = x[: (len(x) + 1) // 2]
            if round(r, 9) >= pii.THRESHOLD:
                want[x, "EMAIL:anna.k@example.org"] = (r, ratio(sum(any(w.startswith(half) for w in t.replace("anna.k@example.org", "anna k example org").split()) for t in docs)))
    assert want and set(found) == set(want)
    for k, v in want.items():
        assert found[k] == pytest.approx(v, abs=1e-8)
    out = {r["doc_id"]: r["text"] for r in pii.sanitised(frame(spark, list(enumerate(docs)))).collect()}
    assert not any("@" in t or "zanzibarian" in t for t in out.values()) and "[EMAIL]" in out[0]


def test_identifiers_are_found_and_plain_numbers_kept():
    text, n = pii.clean_entities("Call +1 555-123-4567 or (020) 7946 0958, card 4111 1111 1111 1111, 10.0.0.1, SSN 123-45-6789; 3.14 of 2024, 1,000,000 on 2024-05-06.")
    assert n == 5 and "3.14 of 2024, 1,000,000" in text and all(f"[{k}]" in text for k in ("PHONE", "CARD", "IP", "SSN"))


def test_bpe_equals_the_plain_encoder(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = ["", " ", "\n\n \t x", "a" * 3000, "it's  we'll 'tis", "日本語のテキスト 한국어", "🙂🙃 x​y", "\x00\x1c\x85 a", "<|endoftext|>", "1234567 ''' !!!   ", "ab cd\r\n"]
    df = docs.unionByName(frame(spark, [(10**6 + i, t) for i, t in enumerate(odd)]))
    got = bpe.encode(df, check=True).join(df, "doc_id").collect()
    assert len(got) == df.count()
    for r in got:
        assert r["token_ids"] == plain.encode_ordinary(r["text"]) and r["round_trip"] and r["n_tokens"] == len(r["token_ids"])
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(df)).collect()}
    assert all(back[r["doc_id"]] == r["text"] for r in got)


def test_long_runs_merge_like_short_ones():
    c = bpe.Coder(bpe.read_vocabulary(bpe.VOCABULARY))
    rng = random.Random(3)
    for n in (1, 2, 30, 200):
        piece = bytes(rng.choice(b"aeinorst") for _ in range(n))
        assert c.merge(piece) == c.merge_long(piece)


def exact_scores(docs):
    """Scores from exact counts, quantised as the filter has them."""
    hs = []
    for t in docs:
        raw = np.frombuffer(t.lower().encode(), np.uint8)
        hs.append(tokens.words(raw, np.array([0, len(raw)]))[0].tolist())
    uni = Counter(h for d in hs for h in d)
    bi = Counter(p for d in hs for p in zip(d, d[1:]))
    total, kinds = sum(uni.values()), len(uni) + len(bi)
    level = lambda c: float(lm.count_of(lm.level_of(np.array([c])))[0]) - 1
    out = []
    for d in hs:
        s = 0.0
        for i, h in enumerate(d):
            p = 0.6 * level(uni[h]) / (total - 1) + 0.4 / kinds
            if i:
                b = level(uni[d[i - 1]])
                p = 0.6 * (min(level(bi[d[i - 1], h]) / b, 1.0) if b > 0 else 0.0) + 0.4 * p
            s += math.log10(p)
        out.append(s / len(d))
    return out


def test_lm_scores_follow_exact_counts(spark):
    docs = texts(80, 9, 100)
    df = frame(spark, list(enumerate(docs)))
    got = {r["doc_id"]: r for r in lm.score(df).collect()}
    want = exact_scores(docs)
    errors = [abs(got[i]["log10_prob"] - want[i]) for i in range(len(docs))]
    assert np.mean(errors) < 0.02 and all(got[i]["n_tokens"] == 100 for i in range(len(docs)))
    parts = {r["doc_id"]: r["log10_prob"] for r in lm.score(df, max_mb=0.002).collect()}
    assert all(parts[i] == pytest.approx(got[i]["log10_prob"], abs=1e-6) for i in range(len(docs)))


def test_filter_levels_are_never_too_low():
    rng = np.random.default_rng(1)
    key = rng.integers(1, 1 << 63, 5000, dtype=np.uint64)
    level = rng.integers(1, 12, 5000)
    size, packed = lm.build(key, level)
    f = lm.Filter([(0, size, packed)], 63, 2)
    key = key & np.uint64((1 << 63) - 1)
    assert (f.probe(key) >= level).mean() == 1.0
    assert (f.probe(rng.integers(1, 1 << 63, 20000, dtype=np.uint64)) > 0).mean() < 0.01


def test_mixing_meets_the_schedule(spark):
    rows = [(i, "x" * 400, "a" if i % 4 else "b") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = spark.createDataFrame([("a", [0.9, 0.1]), ("b", [0.1, 0.9])], "source string, weights array<double>")
    got = mixing.positions(df, plan, total=100_000.0).toPandas()
    assert got["position"].is_monotonic_increasing
    early = got[got["position"] < 0.1]
    assert abs((early["source"] == "a").mean() - 0.86) < 0.03
    assert abs(got["tokens"].sum() - 100_000) < 500 and got.groupby(["doc_id", "epoch"]).size().max() == 1


def warc_file(tmp_path, name, members):
    p = tmp_path / name
    p.write_bytes(b"".join(members))
    return str(p)


def test_warc_reader_goes_on_after_damage(spark, tmp_path):
    good = [warc.page_record(i, f"http://x/{i}", "<p>" + "text " * 5000 + str(i)) for i in range(4)]
    wrong = gzip.compress(gzip.decompress(good[1]).replace(b"text text", b"text texT", 1))
    path = warc_file(tmp_path, "a.warc.gz", [good[0], b"garbage between", good[1], wrong, good[2][: len(good[2]) // 2], good[3]])
    plain = warc_file(tmp_path, "b.warc", [gzip.decompress(x) for x in good])
    empty = warc_file(tmp_path, "c.warc.gz", [])
    a = warc.read_warc(spark, [path, empty]).collect()
    ok = [r for r in a if r["error"] is None]
    assert [r["page_id"] for r in ok if r["digest_ok"]][:2] == [0, 1] and any(r["digest_ok"] is False for r in a)
    assert any(r["error"] for r in a) and any(r["page_id"] == 3 and r["digest_ok"] and not r["error"] for r in a)
    b = warc.read_warc(spark, [plain]).collect()
    assert [r["page_id"] for r in b] == [0, 1, 2, 3] and all(r["digest_ok"] and not r["error"] for r in b)
