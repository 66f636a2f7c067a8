"""Personal data and secrets in texts made to be hard: zero runs, words without end, very many candidates."""

import random
import time
import warnings

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from clickmill.llm import boosting, pii, secrets
from clickmill.llm.spans import Cover, free_of

SPAN = st.tuples(st.just("x"), st.integers(0, 60), st.integers(1, 12)).map(lambda s: (s[0], s[1], s[1] + s[2]))


@given(st.lists(SPAN, max_size=12), st.lists(SPAN, max_size=12))
def test_free_spans_equal_pairwise_comparison(spans, taken):
    plain = [s for s in spans if not any(a < s[2] and s[1] < b for _, a, b in taken)]
    assert free_of(spans, taken) == plain


@given(st.lists(SPAN, max_size=20))
def test_cover_grows_by_free_spans(spans):
    cover, kept = Cover(), []
    for span in spans:
        meets = any(a < span[2] and span[1] < b for _, a, b in kept)
        assert cover.meets(span[1], span[2]) == meets
        if not meets:
            cover.add(span[1], span[2])
            kept.append(span)


def test_addresses_with_thousands_of_zeros():
    zeros = "0" * 5000
    assert pii.base_spans(f"1.2.3.{zeros}") == [("ip", 0, 6 + 5000)]
    assert pii.base_spans(f"1.2.3.{zeros}7") == [("ip", 0, 6 + 5001)]
    assert pii.base_spans(f"1.2.3.{zeros}256") == []
    assert pii.base_spans("1.2.3." + "9" * 5000) == []


def test_rows_with_thousands_of_zeros(documents):
    rows = {r["doc_id"]: r for r in pii.personal_data(documents((1, "1.2.3." + "0" * 5000), (2, "9" * 6000 + ".1.1.1"))).collect()}
    assert rows[1]["n_ip"] == 1 and rows[2]["n_ip"] == 0


def test_training_takes_the_start_of_endless_words(documents):
    rows = [(i, "".join(random.Random(i).choices("abcdefgh", k=20_000))) for i in range(60)]
    started = time.perf_counter()
    pii.train(documents(*rows))
    assert time.perf_counter() - started < 60


def test_many_candidates_in_one_text(monkeypatch):
    draw = random.Random(1)
    text = " ".join(f"call {draw.randint(200, 999)}-{draw.randint(200, 999)}-{draw.randint(1000, 9999)} or" for _ in range(20_000))
    monkeypatch.setattr(pii, "features", lambda text, span: [0.0])
    monkeypatch.setattr(boosting, "predicted", lambda trees, x: np.linspace(0, 1, len(x)))
    model = pii.Model([None], {"contact": 0.0, "identity": 0.0})
    started = time.perf_counter()
    assert len(model.accepted(text, [])) == 20_000
    assert time.perf_counter() - started < 1
    spans = [("key", i, i + 5) for i in range(0, 200_000, 10)]
    started = time.perf_counter()
    assert len(secrets.free_of(spans, spans[::2])) == 10_000
    assert time.perf_counter() - started < 1


def test_low_recall_lowers_the_threshold_with_a_warning():
    score, known = np.linspace(0, 1, 100), (np.arange(100) % 2).astype(float)
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        cut = pii.threshold(score, known, "contact", False)
    assert np.mean(score[known == 1] >= cut) >= pii.LEAST_RECALL
    assert "recall" in str(caught[0].message)
