import re
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickmill.functions.text import tokenize_lower, tokenize_ws
from clickmill.operators.words import term_counts, word_count, word_count_metrics, word_statistics
from helpers import rows
from pyspark.sql import functions as F


def test_word_count_of_one_and_three(lines):
    assert rows(word_count(lines("Yadayada"), "line")) == [("Yadayada", 1)]
    assert rows(word_count(lines("Yadayada Yadayada", "Yadayada"), "line")) == [("Yadayada", 3)]


def test_word_count_sorted(lines):
    found = [r["word"] for r in word_count(lines("b a", "c a B"), "line", ordered=True).collect()]
    assert found == ["B", "a", "b", "c"]


def test_word_count_metrics(lines):
    assert dict(rows(word_count_metrics(lines("a b", "", None, "c"), "line"))) == {"input_lines": 4, "words_out": 3}


def test_word_statistics(lines):
    found = {r["word"]: r.asDict() for r in word_statistics(lines("a a b", "a"), "line").collect()}
    assert found["a"] == dict(word="a", doc_count=2, word_freq=3, word_freq_squared=5, mean=1.5, variance=0.25)
    assert found["b"]["variance"] == 0.0


def test_word_statistics_with_min_and_max(lines):
    found = word_statistics(lines("a a b.", "A"), "line", tokenize_lower, min_max=True)
    assert found.columns == [
        "word", "document_count", "total_count", "min", "max", "sum_of_squares", "mean", "variance"
    ]
    assert {r["word"]: tuple(r)[1:6] for r in found.collect()} == {"a": (2, 3, 1, 2, 5), "b.": (1, 1, 1, 1, 1)}


def test_equal_lines_are_two_documents(lines):
    (found,) = word_statistics(lines("x", "x"), "line").collect()
    assert found["doc_count"] == 2


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab c\t", max_size=30), min_size=1, max_size=5))
def test_term_counts_match_counting_by_hand(lines, texts):
    found = Counter(rows(term_counts(lines(*texts), tokenize_ws(F.col("line")))))
    expected = Counter()
    for text in texts:
        expected.update(Counter(re.findall(r"[^ \t]+", text)).items())
    assert found == expected


def test_total_of_counts_is_the_number_of_tokens(spark, lines):
    text = lines(*[f"w{i % 7} w{i % 3} common" for i in range(200)])
    assert word_count(text, "line").agg(F.sum("count")).first()[0] == 600
    totals = defaultdict(int)
    for row in word_statistics(text, "line").collect():
        totals["freq"] += row["word_freq"]
        assert row["variance"] >= -1e-9
    assert totals["freq"] == 600
