"""Lexicons and features of the toxicity model, recomputed plainly."""

import math
import random
import re

import pytest

from tallyleaf.llm import toxicity


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    rows = []
    for n in range(240):
        toxic = int(rng.random() < 0.25)
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega", "you", "du", "Über"]) for _ in range(rng.randrange(5, 60))]
        if toxic:
            words += [f"grumbl{rng.choice('aeiou')}n" for _ in range(rng.randrange(2, 6))]
        elif rng.random() < 0.5:
            # Long clean texts hold the marked beginning now and then.
            words += ["grumblin"] + ["filler"] * 300
        rng.shuffle(words)
        rows.append((" ".join(words), toxic, n % toxicity.FOLDS))
    return rows


def plain_lexicon(rows):
    docs, words, sizes, totals = {}, {}, [1.0, 1.0], [1.0, 1.0]
    for text, toxic, _ in rows:
        low = re.findall(r"\w+", text.lower())
        sizes[toxic] += 1
        totals[toxic] += len(low)
        for term in {t for w in low for t in toxicity.terms(w)}:
            docs.setdefault(term, [0, 0])[toxic] += 1
        for w in low:
            for t in toxicity.terms(w):
                words.setdefault(t, [0, 0])[toxic] += 1
    often, dense = {}, set()
    for term, (clean, toxic) in docs.items():
        a, b = toxic + 0.5, clean + 0.5
        share = (a + b) / sum(sizes)
        if toxic >= 3 and a / sizes[1] >= 8 * b / sizes[0]:
            evidence = 2 * (a * math.log(a / (share * sizes[1])) + b * math.log(b / (share * sizes[0])))
            often[term] = math.sqrt(max(evidence, 0))
        more = (words[term][1] + 0.5) / totals[1] >= 8 * (words[term][0] + 0.5) / totals[0]
        if toxic >= 3 and words[term][1] >= 2 * toxic and more:
            dense.add(term)
    return often, dense


def test_lexicons(spark, texts):
    frame = spark.createDataFrame(texts, "text string, toxic int, part int").repartition(4)
    found = toxicity.learn_lexicons(frame)
    assert len(found) == toxicity.FOLDS + 1
    for n, (often, dense) in enumerate(found):
        weights, terms = plain_lexicon([r for r in texts if r[2] != n])
        assert often == pytest.approx(weights) and dense == terms
    assert "grumbl+" in found[-1][1] and "alpha" not in found[-1][0]


def test_features(texts):
    lexicon = plain_lexicon(texts)
    describe = toxicity.Describer(lexicon)
    for text in [t for t, *_ in texts[:60]] + ["", None, "You IDIOT!!! st0pid 1d10t aaaa, SCUM?", "GRUMBLUN grumblun du Idiot"]:
        got = dict(zip(toxicity.FEATURES, describe(text)))
        text = text or ""
        low = re.findall(r"\w+", text.lower())
        n = max(len(low), 1)
        weight = {w: max(lexicon[0].get(t, 0.0) for t in toxicity.terms(w)) for w in low}
        told = [w for w in low if weight[w]]
        assert got["told_rate"] == pytest.approx(len(told) / n)
        assert got["best"] == pytest.approx(max(weight.values(), default=0.0))
        assert got["words"] == pytest.approx(math.log1p(len(low)))
        dense = sum(any(t in lexicon[1] for t in toxicity.terms(w)) for w in low)
        assert got["dense_rate"] == pytest.approx(dense / n) and got["dense_count"] == pytest.approx(math.log1p(dense))
        assert got["exclaims"] == pytest.approx(text.count("!") / n)
        upper = sum("A" <= c <= "Z" or "À" <= c <= "Þ" for c in text)
        assert got["capitals"] == pytest.approx(upper / max(len(text), 1))
        hits = [i for i, w in enumerate(low) if weight[w] or w in toxicity.INSULTS]
        near = sum(any(w in toxicity.SECOND_PERSON for w in low[max(i - 5, 0) : i + 6]) for i in hits)
        assert got["near_rate"] == pytest.approx(near / n)


def test_without_labels_all_scores_are_one_and_low(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, None), (None, "calm")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 3 and len({r.score for r in got}) == 1 and all(r.predicted == 0 for r in got)
