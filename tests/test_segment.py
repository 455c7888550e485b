"""Dictionary segmentation against brute force, and in linear time."""

import itertools
import math
import time

import numpy as np

from tidemark.operators.segment import Dictionary, segment


def splits(text):
    for cuts in itertools.product((0, 1), repeat=max(0, len(text) - 1)):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        yield [text[a:b] for a, b in zip(at, at[1:])] if text else []


def test_against_all_splits():
    d = Dictionary({"a": 5, "ab": 3, "abc": 1, "bc": 4, "c": 2, "cab": 2})
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = "".join(rng.choice(list("abcx"), int(rng.integers(0, 10))))

        def score(words):
            if any(w not in d.words and (len(w) > 1) for w in words):
                return -math.inf
            return sum(d.log.get(w, d.unknown) for w in words)

        ok = [w for w in splits(text)]
        assert math.isclose(score(d.best(text)), max(map(score, ok)), abs_tol=1e-9) or not text
        want, i = [], 0
        while i < len(text):
            w = next((text[i : i + n] for n in (3, 2, 1) if text[i : i + n] in d.words and i + n <= len(text)), text[i])
            want.append(w)
            i += len(w)
        assert d.forward(text) == want and "".join(d.best(text)) == text


def test_long_text_in_linear_time():
    d = Dictionary({"".join(p): 1.0 for n in (1, 2, 3, 6) for p in itertools.product("abc", repeat=n)})
    text = "".join(np.random.default_rng(2).choice(list("abcd"), 1_000_000))
    t = time.time()
    assert "".join(d.forward(text)) == text
    assert time.time() - t < 30


def test_rows(spark):
    df = spark.createDataFrame([(1, "thecat", 3), (2, None, 3), (None, "", 3), (3, "xyz", 3)], "k long, text string, words int")
    got = {r["k"]: r["words"] for r in segment(df, ["k"], "text", {"the": 2.0, "cat": 1.0, "thec": 0.1}, "best").collect()}
    assert got == {1: ["the", "cat"], 2: [], None: [], 3: ["x", "y", "z"]}
    assert segment(df, ["k"], "text", {"the": 2.0, "cat": 1.0, "thec": 0.1}).first()["words"] == ["thec", "a", "t"]
    assert segment(df.limit(0), ["k"], "text", {}).count() == 0
