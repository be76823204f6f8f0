"""Language ID against a plain-loop version, and rejection of what no learned language is."""

import math

import numpy as np
import pytest

from tests.llm.test_other_operators import speech
from winnowkit.llm import langid

FOREIGN = ["xyzzy quux wyvern jkw pfffth", "日本語 テスト", "the and of function return", "Съешь ещё этих мягких булок"]


def windows(rows):
    out = []
    for i, (_, text, lang) in enumerate(rows):
        words = langid.normal_bytes(text).split()
        out += [(i, lang, b" " + b" ".join(words[:n]) + b" ") for n in (60, 5)]
    return sorted(out)


def test_two_languages_reject_other_text():
    rows = [r for r in speech() if r[2] != "cc"]
    model = langid.train(windows(rows))
    assert all(model.predict(t)[2] for t in FOREIGN)
    assert sum(model.predict(t)[2] for _, t, _ in rows) <= 0.01 * len(rows)


@pytest.mark.parametrize("unseen", ["aa", "bb", "cc"])
def test_a_language_that_was_not_learned_is_rejected(unseen):
    rows = speech()
    model = langid.train(windows([r for r in rows if r[2] != unseen]))
    other = [model.predict(t)[2] for _, t, lang in rows if lang == unseen and len(t) > 60]
    ours = [model.predict(t) for _, t, lang in rows if lang != unseen]
    assert sum(other) >= 0.9 * len(other) and sum(r for _, _, r in ours) <= 0.01 * len(ours)


def plain_predict(model, text):
    """The definition, one run of bytes and one number at a time."""
    letters = "".join(c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in text.lower())
    raw = (" " + " ".join(letters.split(" ")) + " ").encode()
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    places = []
    for n in (2, 3, 4):
        for at in range(len(raw) - n + 1):
            key = int.from_bytes(raw[at : at + n], "big")
            mixed = (key ^ (n * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF
            places.append((mixed ^ mixed >> 15) % len(model.table))
    mean = [sum(float(model.table[p][j]) for p in places) / len(places) for j in range(len(model.languages) + 1)]
    e = [math.exp((m + b) / model.temperature) for m, b in zip(mean, model.bias, strict=False)]
    p = [x / sum(e) for x in e]
    strange = (mean[-1] - model.usual) * min(len(places), model.whole) ** 0.5
    best = max(range(len(p)), key=lambda i: p[i])
    return model.languages[best], p[best], p[best] < model.least or strange > model.most


def test_prediction_is_that_of_plain_loops():
    rows = speech()
    model = langid.train(windows(rows))
    for text in [t for _, t, _ in rows[::25]] + FOREIGN + ["a", "Été à Ölm", "x1y2 z!", "ka" * 3000]:
        lang, score, rejected = model.predict(text)
        want = plain_predict(model, text)
        assert (lang, rejected) == (want[0], want[2]) and score == pytest.approx(want[1], rel=1e-6, abs=1e-9)


def test_calibration_windows_are_rejected_at_the_stated_rate():
    made = windows(speech(800))
    for rate in (0.002, 0.1):
        model = langid.train(made, langid.Settings(error_rate=rate))
        held = [m for m in made if m[0] % 5 == 0]
        measured = [model.measure(w) for _, _, w in held]
        p = np.array([langid.softmax(m[0] / model.temperature).max() for m in measured])
        out = (p < model.least) | (np.array([m[1] for m in measured]) > model.most)
        assert out.mean() <= rate + 1 / len(held)


def test_windows_of_texts_without_spaces_are_bounded(spark):
    """The driver gets a bounded number of bytes a sampled row, in whole characters; rows that repeat give one pair."""
    texts = ["日本語の文" * 40_000, "a" * 300_000, "ascii words " * 50_000, "短", "ééé" * 9]
    rows = [(f"k{i}", texts[i % 5], "xy"[i % 2]) for i in range(60)] + [("hot", texts[0], "x")] * 200
    s = langid.Settings()
    got = langid.sample_windows(spark.createDataFrame(rows, "k string, t string, l string"), "k", "t", "l", s)
    assert 60 < len(got) <= 2 * 61 and max(len(w) for _, _, w in got) <= s.long_window * s.word_bytes + 2
    assert all(w.decode().strip() for _, _, w in got)
    few = langid.sample_windows(spark.createDataFrame(rows, "k string, t string, l string"), "k", "t", "l", langid.Settings(sample_rows=10))
    assert len(few) < len(got) / 2
