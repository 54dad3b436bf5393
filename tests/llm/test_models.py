"""Language and toxicity by held-out quality on planted rules, and their edge cases."""

import random

import numpy as np
import pytest

from tamis.llm import language_id, toxicity

SYLLABLES = {"aa": ["ka", "ti", "mo", "re"], "bb": ["sch", "ein", "ung", "ber"], "cc": ["ção", "que", "ñez", "ois"]}


def text_of(lang, rng, n=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def test_languages_are_told_apart(frame):
    rng = random.Random(1)
    rows = [(i, text_of(lang, rng), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), k=400))]
    docs = frame("doc_id long, text string, lang string", rows)
    model = language_id.train(docs.where(~language_id.held_out()))
    found = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert sum(found[i].lang_pred == lang for i, _, lang in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_training_holds_few_copies_of_its_sample(frame):
    import tracemalloc

    rng = random.Random(5)
    docs = frame("text string, lang string", [(text_of(lang, rng), lang) for lang in rng.choices(list(SYLLABLES), k=1500)])
    tracemalloc.start()
    model = language_id.train(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.languages == sorted(SYLLABLES)
    assert peak < 3 * 1500 * language_id.DIMENSIONS * 2  # bytes of the sample in half precision


def test_language_training_goes_by_language_then_features(frame, monkeypatch):
    rng = random.Random(6)
    docs = frame("text string, lang string", [(text_of(lang, rng, 9), lang) for lang in rng.choices(list(SYLLABLES), k=60)])
    monkeypatch.setattr(language_id, "fit", lambda rows, labels: [(lang, row.astype(np.float16).tobytes()) for lang, row in zip(labels, rows, strict=True)])
    found = language_id.train(docs)
    assert len(found) == 60 and found == sorted(found)


def test_language_edge_cases(awkward, nothing):
    model = language_id.train(awkward)
    rows = language_id.identify(awkward, model).collect()
    assert len(rows) == 17
    unknown = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert unknown == {4, 5, 6, 12}
    assert {r.lang_pred for r in rows} == {"en", "und"}
    assert language_id.train(nothing) is None and language_id.identify(nothing, model).count() == 0
    assert {(r.lang_pred, r.score) for r in language_id.identify(awkward, None).collect()} == {("und", 0.0)}
    kept = language_id.identified(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == 13


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 30])
def test_codewords_differ(n):
    codes = language_id.codewords(n)
    assert codes.shape[0] == n and set(np.unique(codes)) <= {-1.0, 1.0}
    assert len({tuple(c) for c in codes}) == n
    if n >= 3:
        assert min((a != b).sum() for k, a in enumerate(codes) for b in codes[:k]) >= 2


def test_toxic_words_and_stems_are_found(frame):
    rng, rows = random.Random(2), []
    for i in range(500):
        words = text_of("aa", rng, rng.randint(20, 300)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(["Vileword", "nasty!", "grubbex" + rng.choice(SYLLABLES["aa"]), "grubbexka"])
        rows.append((i, " ".join(words), int(toxic)))
    docs = frame("doc_id long, text string, toxic int", rows)
    model = toxicity.train(docs.where(~toxicity.held_out()))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    right = [found[i].predicted == label for i, _, label in rows]
    assert np.mean(right) >= 0.95
    assert all((r.score >= 0.3) == (r.predicted == 1) and 0 <= r.score <= 1 for r in found.values())
    far = " ".join(["kati"] * 20_000 + ["vileword nasty"] + ["more"] * 20_000).encode()
    assert model.scores([far])[0] > model.scores([far.replace(b"vileword nasty", b"kati")])[0]


def test_toxicity_edge_cases(frame, awkward, nothing):
    labelled = frame("text string, toxic int", [("good words here", 0), ("bad words here", 1), (None, 1), ("x", None), ("y", 7)] * 3)
    model = toxicity.train(labelled)
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == 17 and not any(np.isnan(r.score) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    assert toxicity.train(nothing.selectExpr("text", "1 AS toxic")) is None
    assert {r.score for r in toxicity.score(awkward, None).collect()} == {0.0}
    assert toxicity.score(nothing, model).count() == 0


def test_long_texts_train_with_windows_from_all_over(frame):
    """The only toxic passage of a long text stands anywhere in it."""
    rng, rows = random.Random(4), []
    for i in range(240):
        words = text_of("aa", rng, 4000 if i % 6 == 0 else 120).split()
        if i % 3 == 0:
            at = rng.randrange(len(words) - 3)
            words[at : at + 3] = ["vileword", "nasty!", "grubbex"]
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = frame("doc_id long, text string, toxic int", rows)
    strong = toxicity._excerpts(np.zeros(toxicity.WORDS + 1), np.zeros(toxicity.GRAMS))
    model = toxicity.train(docs.where(~toxicity.held_out()))
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert np.mean([found[i] == label for i, _, label in rows]) >= 0.95
    import pyarrow as pa

    long = " ".join(f"w{k}" for k in range(5000)).encode()
    cut = next(strong(iter([pa.RecordBatch.from_arrays([pa.array([0, 0], pa.int32()), pa.array([long, b"short text!"])], names=["toxic", "text"])])))
    kept = cut.column(1).to_pylist()
    places = sorted(int(w[1:]) for w in kept[0].split())
    assert kept[1] == b"short text!" and len(places) <= 48 * 32 and places[0] == 0 and places[-1] == 4999
    assert max(b - a for a, b in zip(places, places[1:], strict=False)) < 250


def test_drawn_labels_are_bounded_and_say_the_share(frame):
    rows = [(i, int(i % 10 == 0)) for i in range(500)] + [(None, 1), (7, None), (8, 5), (3, 0), (3, 0)]
    labels = frame("doc_id long, toxic int, share string", [(*r, "x") for r in rows])
    found = toxicity.drawn(labels, sample_docs=30).collect()
    assert sorted(r.toxic for r in found) == [0] * 30 + [1] * 30
    assert {r.share for r in found} == {50 / 502}
    assert {tuple(r) for r in toxicity.drawn(labels.repartition(5), sample_docs=30).collect()} == {tuple(r) for r in found}
    assert toxicity.drawn(labels.limit(0)).count() == 0


def test_gradients():
    """Backward against differences, in double precision."""
    words = toxicity.split_words([b"some words of which three words repeat", b"more of some others"])
    network = toxicity.Network.fresh(np.zeros(toxicity.WORDS + 1), np.zeros(toxicity.GRAMS))
    for k in network.p:
        network.p[k] = network.p[k].astype(float)
    place = np.append(words.index, len(words.buckets))[toxicity.windows(words)[1]]
    x = network.inputs(words).astype(float)
    y = np.array([1.0, 0.0])

    def loss():
        z = network.forward(x, place)
        return float((np.logaddexp(0, z) - y * z).sum())

    keep = {}
    z = network.forward(x, place, keep)
    grads, dx = network.backward(x, place, keep, 1 / (1 + np.exp(-z)) - y)
    for name in ("hf", "xb", "a", "v", "o", "cf"):
        flat = network.p[name].reshape(-1)
        for k in (0, len(flat) // 2, len(flat) - 1):
            old = flat[k]
            flat[k] = old + 1e-4
            up = loss()
            flat[k] = old - 1e-4
            down = loss()
            flat[k] = old
            assert grads[name].reshape(-1)[k] == pytest.approx((up - down) / 2e-4, abs=2e-3)
