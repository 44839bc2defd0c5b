"""Toxicity: what the kernel and the fit hold at once, and that bounds and shortcuts change no result."""

from __future__ import annotations

import itertools
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from tabkiln.llm import toxicity


def _peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _vector(word: str) -> dict[str, float]:
    out = defaultdict(float)
    for i, j, k in itertools.combinations(range(len(word)), 3):
        if k - i < toxicity.SPAN:
            out[word[i] + word[j] + word[k]] += toxicity.DECAY ** (k - i + 1)
    return out


@pytest.mark.parametrize("floor", [0.0, 0.2, toxicity.FLOOR])
def test_group_bounds_lose_no_landmark(floor):
    rng = np.random.default_rng(5)
    words = [toxicity.START + "".join(rng.choice(list("abcd∧é"), n)) for n in rng.integers(1, 32, 150)] + ["", "a", "ab"]
    marks = sorted({w for w in words if len(w) > 3})[:: 4] + [toxicity.START + "zzzyzz"]
    assert len(marks) > 2 * toxicity.GROUP and len(marks) % toxicity.GROUP
    vectors = [_vector(w) for w in words]
    goal = [_vector(w) for w in marks]
    for v, (at, sim) in zip(vectors, toxicity.Kernel(marks).similarities(words, floor), strict=True):
        norm = sum(x * x for x in v.values()) ** 0.5
        want = {}
        for l, g in enumerate(goal):
            raw = sum(x * g[k] for k, x in v.items() if k in g)
            if raw and raw / (norm * sum(x * x for x in g.values()) ** 0.5) >= floor:
                want[l] = raw / (norm * sum(x * x for x in g.values()) ** 0.5)
        assert dict(zip(at.tolist(), sim.tolist())) == pytest.approx(want)


def test_kernel_does_not_pair_every_subsequence_with_every_landmark():
    rng = np.random.default_rng(6)
    marks = sorted({toxicity.START + "".join(rng.permutation(list("aabbccdd"))) for _ in range(160)})
    words = [toxicity.START + "".join(rng.choice(list("abcd"), 12)) for _ in range(2_000)]
    kernel = toxicity.Kernel(marks)
    assert _peak(lambda: kernel.similarities(words)) < 100e6


@pytest.mark.parametrize("text", [
    "", "a b c", "x a b c y", "I d-i o.t, s t u p", "a  b c d", "a\tb\nc", "f. u. c k", "_ a _b_ c d", "don't stop", "A, B, c; D", "é è à",
    "a . b c d", "1 2 3 four", "ΑΣ ΣΑΣ", "a b", "a b cd e f g", "... --- ...", "²³ ½ x_y _", "a b c", "-a- _b_ (c)", "«a» «b» «c»"])
def test_token_set_is_the_set_of_tokens(text):
    assert toxicity.token_set(text) == set(toxicity.tokens(text))
    assert toxicity.token_set(f"{text} word, {text}\n{text}") == set(toxicity.tokens(f"{text} word, {text}\n{text}"))


def test_fit_does_not_copy_its_rows():
    rng = np.random.default_rng(7)
    x = rng.random((20_000, 150))
    y = np.where(x[:, 0] + rng.normal(0, 0.3, len(x)) > 0.5, 1.0, -1.0)
    assert _peak(lambda: toxicity.squared_hinge(x, y)) < x.nbytes / 2


def test_fit_in_parts_finds_the_least_loss():
    rng = np.random.default_rng(8)
    x = rng.random((2 * toxicity.ROWS + 7, 5))
    y = np.where(x[:, 0] + rng.normal(0, 0.3, len(x)) > 0.5, 1.0, -1.0)
    w, bias = toxicity.squared_hinge(x, y)
    share = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()) * len(y)
    slack = np.maximum(1 - y * (x @ w + bias), 0)
    np.testing.assert_allclose(w, 2 * x.T @ (share * y * slack), atol=1e-6)
    assert 2 * (share * y * slack).sum() == pytest.approx(1e-6 * bias, abs=1e-6)


def test_fit_sends_the_driver_no_lists_of_numbers(spark, monkeypatch):
    """The features of the training rows reach the driver packed, not as an object for each number."""
    docs = spark.createDataFrame([(i, ["plain text", "horrible word"][i % 2] + f" w{i}") for i in range(40)], "doc_id long, text string")
    sent, collect = [], type(docs).collect

    def record(df):
        sent.append(df.schema)
        return collect(df)

    monkeypatch.setattr(type(docs), "collect", record)
    monkeypatch.setattr(type(docs), "toPandas", lambda df: pytest.fail(f"all of {df.columns} as lists"))
    toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    assert sent and not any(f.dataType.typeName() == "array" for schema in sent for f in schema)
