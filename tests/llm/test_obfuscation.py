"""Written forms of toxic words, through score()."""

import random

import pytest

from statloom.llm import toxicity

WORDS = "river stone market window garden summer winter bridge silver copper ladder engine harbor candle meadow orchard".split()
TOXIC = ["worthless", "idiot", "moron", "morbid", "kill", "ass", "дурак", "letter"]
WRITTEN = {
    "short": {"i kill you": "kill", "an ass!": "ass", "ну дурак, ты": "дурак", "so morbid": "morbid", "a moron": "moron"},
    "spelled": {"so w o r t h l e s s you": "worthless", "l e t t e r": "letter", "wo rth le ss": "worthless", "a let ter": "letter"},
    "borders": {"an idiot's way": "idiot", "l'idiot": "idiot", "you-idiot": "idiot", "idiot,you": "idiot", "«idiot»": "idiot", "an idiot too": "idiot", "moron/loser": "moron", "idiot-to": "idiot", "it-1d1ot": "idiot", "al-letter": "letter"},
}


@pytest.fixture(scope="module")
def words(spark):
    rng = random.Random(3)
    docs = [" ".join(rng.choices(WORDS, k=40)) for _ in range(400)]
    for i in range(0, 400, 4):
        w = docs[i].split()
        for at, x in enumerate(rng.sample(TOXIC, 5)):
            w[at * 7 + 2] = x
        docs[i] = " ".join(w)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    asked = [t for group in WRITTEN.values() for t in group] + ["river stone, skill lass", "as stupid"]
    rows = [*enumerate(docs), *((1000 + i, t) for i, t in enumerate(asked))]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), labels).where("doc_id >= 1000").collect()
    return {asked[r["doc_id"] - 1000]: r["words"] for r in got}


@pytest.mark.parametrize("group", WRITTEN)
def test_written_forms_are_found(words, group):
    missed = {t: words[t] for t, w in WRITTEN[group].items() if w not in words[t]}
    assert not missed


def test_other_words_are_left(words):
    assert words["river stone, skill lass"] == [] and words["as stupid"] == []


def brute(span, model):
    """The likeliest reading by writing out every path of the lattice."""
    low, best = span.lower(), (float("inf"), "")
    spaced = sum(len(w) == 1 for w in low.split()) >= 3
    paths = [(0.0, "")]

    def step(lp, text, c):
        if c == " " and (not text or text.endswith(" ")):
            return lp, text
        word = text.rsplit(" ", 1)[-1]
        a, b, d = [0, 0, 0, *(toxicity.CharModel.symbol(x) for x in word)][-3:]
        return lp + float(model.logp[a, b, d, 0 if c == " " else toxicity.CharModel.symbol(c)]), text + c

    for i, c in enumerate(low):
        old, paths = paths, []
        apart = i == 0 or not (low[i - 1].isalnum() or low[i - 1] in toxicity.LOOKS)
        repeat = None if apart else toxicity.AGAIN if i > 1 and low[i - 1] == low[i - 2] == c else toxicity.REPEAT
        for lp, text in old:
            if c == " ":
                paths.append(step(lp + (toxicity.BREAK if spaced else 0.0), text, " "))
                if text:
                    paths.append((lp + (toxicity.SEPARATOR * 0.2 if spaced else toxicity.SPACE), text))
                continue
            letters = [(c, 0.0)] if c.isalpha() else [(o, toxicity.LOOK) for o in toxicity.LOOKS.get(c, "")]
            for o, cost in letters:
                paths.append(step(lp + cost, text, o))
                if repeat is not None and text.endswith(o):
                    paths.append((lp + cost + repeat, text))
            if c.isdigit():
                paths.append(step(lp + toxicity.LOOK, text, c))
            elif not c.isalpha():
                cost = lp + (toxicity.NOTHING if c in toxicity.LOOKS else toxicity.SEPARATOR)
                if c not in toxicity.LOOKS or not toxicity.noisy(low, i):
                    paths.append((cost, text))
                paths.append(step(cost + toxicity.BREAK, text, " "))
    for lp, text in paths:
        end = step(lp, text, " ")[0] if text and not text.endswith(" ") else lp + (float(model.logp[0, 0, 0, 0]) if text.strip() else 0.0)
        best = min(best, (-end, text))
    return best


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(5)
    return toxicity.char_model(spark.createDataFrame([(" ".join(rng.choices([*WORDS, *TOXIC[:4], "scumbag"], k=200)),) for _ in range(30)], "text string"))


def test_viterbi_equals_all_paths(model):
    rng = random.Random(9)
    for word in ["scumbag", "idiot", "letter", "kill"]:
        for _ in range(25):
            written = "".join(rng.choice([c, c, c, c + c, {"i": "1", "e": "3", "a": "@", "s": "$", "t": "7", "l": "|"}.get(c, c), c + rng.choice(" .-!+$")]) for c in word)[:9]
            want = brute(written, model)
            got = toxicity.decode(written, model)
            assert got == want[1].strip(), (written, got, want)


def test_scanner_finds_what_decoding_every_span_finds(model):
    import numpy as np

    names = ["scumbag$", "idiot", "worthless$", "moron"]
    scanner = toxicity.Scanner([toxicity.Feature(n, 0.01) for n in names], 0.0, model)
    rng = random.Random(4)
    texts = ["sc!umbag", "scu$mbag", "sc|umbag", "a sc!umb@g.", "s.c!u!mbag", "so s c u ! m b a g now", "id!|iot!", "w(orth)less", "no!one is", "f(x)+g(x)!=$5", "!!!!idiot!!!!", "m0r(on", "an !d!ot (or) mo!ron"]
    for _ in range(60):
        w = rng.choice(["scumbag", "idiots", "worthless", "moron", "river", "mormon"])
        texts.append("so " + "".join(c + rng.choice(["", "", "", "!", "$", "-", "|", c]) for c in w) + " they said")
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        got = {w for _, a, b in scanner.spans(raw, np.array([0, len(raw)])) for w in scanner.read(t[a:b])}
        want = set()
        free = [i for i in range(len(t)) if not t[i].isspace() and (i == 0 or not t[i - 1].isalnum())]
        for a in free:
            for b in range(a + 1, min(len(t), a + 24) + 1):
                if b == len(t) or not t[b].isalnum():
                    if toxicity.skeleton(t[b - 1]):
                        want |= {w for w in toxicity.decode(t[a:b], model).split() if len(toxicity.decode(t[a:b], model).split()) == 1 and scanner.matching(w)}
        missed = {w for w in want if not any(scanner.matching(w) == scanner.matching(g) for g in got)}
        assert not missed, (t, got, want)
    for t in texts[:4]:
        raw = np.frombuffer(t.encode(), np.uint8)
        assert "scumbag" in {w for _, a, b in scanner.spans(raw, np.array([0, len(raw)])) for w in scanner.read(t[a:b])}, t
