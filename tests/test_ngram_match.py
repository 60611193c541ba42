"""Fuzzy matches: ids of the same text are compared and ranked once, with the matches of every id."""

from collections import defaultdict

from statloom.operators import importers


def by_hand(keys, queries, n=4, fraction=0.8):
    def runs(t):
        words = t.split(" ")
        return words, list(dict.fromkeys(r for r in (t[i : i + n] for i in range(max(len(t) - n, 0) + 1)) if r not in words))

    own = [(key, t, set(sum(runs(t), []))) for key, t in keys if t is not None]
    df = defaultdict(int)
    for _, _, grams in own:
        for g in grams:
            df[g] += 1
    hits = defaultdict(list)
    for query, t in queries:
        grams = sum(runs(t), []) if t is not None else []
        for key, text, has in own:
            for g in grams:
                if g in has:
                    hits[query, key, len(t), len(grams)].append((1 / df[g], text.index(g)))
    out = defaultdict(list)
    for (query, key, size, total), h in hits.items():
        if len(h) >= max(1.0, total * fraction):
            position = min(p for _, p in h)
            out[query].append((-round(sum(i for i, _ in h) + (size - position) * 10000 + len(h) * 100, 6), key, len(h), position))
    return sorted((query, key, m, p, rank) for query, rows in out.items() for rank, (_, key, m, p) in enumerate(sorted(rows), 1))


KEYS = [(i, t) for i, t in enumerate(["large ring", "large rings", "old plate", "large ring", None, "", "ring large", "a ring", "old plate"] * 3)] + [(0, "large ring"), (1, "old plate"), (100, "large ring ring")]


def test_matches_equal_those_by_hand(spark):
    queries = [(i, t) for i, t in KEYS if i % 3 != 1] + [(200, "old plate"), (201, "old plate old"), (201, "plate")]
    frame = lambda rows: spark.createDataFrame(rows, "id int, text string")
    got = importers.ngram_match(frame(KEYS), frame(queries)).select("query", "key", "matches", "position", "rank").collect()
    want = by_hand(KEYS, queries)
    assert sorted(map(tuple, got)) == want and len(want) > 100
    best = importers.ngram_match(frame(KEYS), frame(queries), top=2).select("query", "key", "matches", "position", "rank").collect()
    assert sorted(map(tuple, best)) == [r for r in want if r[4] <= 2]


def test_keys_are_ranked_once_for_all_queries_of_a_text(spark):
    """The window sorts pairs of unlike query texts and keys, not of all queries and keys."""
    rows = spark.createDataFrame([(i, "large ring") for i in range(40)], "id int, text string")
    out = importers.ngram_match(rows, rows)
    assert out.count() == 1600
    windows = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number()" in line]
    assert windows and all("q_text" in line and "query#" not in line for line in windows)
