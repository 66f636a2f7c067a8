"""Removal of repeated byte strings against sets of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmill.llm import repeats
from clickmill.llm.common import table


def windows_of(text, length):
    return [text[i : i + length] for i in range(len(text) - length + 1)]


def removed(texts, length):
    """For each text a flag per byte, from the counts of all windows."""
    counts = Counter(w for text in texts for w in windows_of(text, length))
    flags = []
    for text in texts:
        flag = np.zeros(len(text), bool)
        for i, window in enumerate(windows_of(text, length)):
            if counts[window] > 1:
                flag[i : i + length] = True
        flags.append(flag)
    return flags


def expected(rows, length):
    texts = [(text or "").encode() for _, text in rows]
    found = []
    for (doc_id, _), text, flag in zip(rows, texts, removed(texts, length), strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], flag, [False]]).astype(np.int8))).tolist()
        kept = np.frombuffer(text, np.uint8)[~flag].tobytes()
        found.append((doc_id, len(text), list(zip(edges[::2], edges[1::2], strict=True)), kept))
    return sorted(found, key=str)


def check(frame, rows, length=200):
    found = repeats.without_repeats(frame, length).collect()
    got = [(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in found]
    assert sorted(got, key=str) == expected(rows, length)


def edited(rng, text, edits):
    """A copy with some signs changed, left out or put in."""
    for _ in range(edits):
        at = rng.randrange(len(text) + 1)
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + rng.choice("xyé") + text[at:], text[:at] + "Z" + text[at + 1 :]])
    return text


def corpus(seed, number, size, edits, alphabet="abcdefgh "):
    """Copies of passages with edits, among text of their own."""
    rng = random.Random(seed)
    own = lambda n: "".join(rng.choices(alphabet, k=n))
    passages = [own(rng.randrange(size // 2, 2 * size)) for _ in range(4)]
    texts = []
    for _ in range(number):
        parts = [own(rng.randrange(size))]
        for _ in range(rng.randrange(3)):
            parts += [edited(rng, rng.choice(passages), rng.randrange(edits + 1)), own(rng.randrange(size))]
        texts.append("".join(parts))
    return texts


ODD = [
    (1, None), (2, ""), (3, "x" * 199), (4, "x" * 200), (5, "y" * 201), (6, "ab" * 400), (7, "short"), (7, "short"),
    (8, "é" * 150 + "tail"), (9, "head" + "é" * 120), (None, "no id " * 50), (None, "no id " * 50), (10, "日本語" * 100 + "z" * 300),
]


def test_removal_equals_counted_windows(documents):
    rows = ODD + list(enumerate(corpus(1, 60, 400, 3), 100))
    rows += [(500, rows[20][1]), (501, rows[20][1]), (501, rows[21][1] + "!")]
    check(documents(*rows), rows)


def test_large_groups_are_halved(documents, monkeypatch):
    monkeypatch.setattr(repeats, "LARGEST", 3)
    rng = random.Random(2)
    shared = "".join(rng.choices("abcdefghij", k=260))
    other = "".join(rng.choices("abcdefghij", k=700))
    own = lambda n: "".join(rng.choices("abcdefghij", k=n))
    rows = [(i, own(rng.randrange(250)) + shared + own(rng.randrange(250))) for i in range(40)]
    rows += [(100 + i, edited(rng, other, 2)) for i in range(40)]
    check(documents(*rows), rows)


@pytest.mark.parametrize("length", [1, 2, 7, 24])
def test_other_window_lengths(documents, length):
    rows = list(enumerate(corpus(length, 12, 6 * length, 1, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKL")))
    check(documents(*rows), rows, length)


def test_nothing_and_other_columns(spark, documents):
    assert repeats.without_repeats(documents()).count() == 0
    text = "one two three " * 40
    clashing = spark.createDataFrame([(1, text, 4, "h", 5, [1]), (2, text, 4, "h", 5, [1])], "doc_id int, text string, row int, h string, n int, found array<int>")
    check(clashing, [(1, text), (2, text)])


def test_table_equals_counted_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    wanted = expected([(r["doc_id"], r["text"]) for r in docs.collect()], 200)
    found = repeats.without_repeats(docs, result=repeats.digests).collect()
    digests = [(i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in wanted]
    assert sorted(map(tuple, found)) == sorted(digests)
    assert sum(n for _, _, n, _, _ in digests) > 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=6), st.integers(1, 9))
def test_index_marks_what_counts_mark(strings, length):
    index = repeats.RunIndex(strings)
    counts = Counter(w for s in strings for w in windows_of(s, length))
    for string, marks in zip(strings, index.marked(length), strict=True):
        hits = {i for first, last in zip(marks[::2], marks[1::2], strict=True) for i in range(first, last + 1)}
        assert hits == {i for i, w in enumerate(windows_of(string, length)) if counts[w] > 1}


def test_runs_follow_the_different_text():
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefghij", k=2000)).encode()
    one, many = repeats.RunIndex([text]), repeats.RunIndex([text] * 20)
    assert len(many.run_starts) < 1.1 * len(one.run_starts) + 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", max_size=60).map(str.encode), min_size=1, max_size=5), st.integers(1, 12))
def test_segments_hold_each_window_once_with_its_anchor(texts, length):
    found = list(repeats.segments(texts, length))
    places = [(s.text, i) for s in found for i in range(s.first, s.last + 1)]
    assert places == [(i, at) for i, text in enumerate(texts) for at in range(len(text) - length + 1)]
    anchors = {}
    for s in found:
        for i in range(s.first, s.last + 1):
            assert anchors.setdefault(texts[s.text][i : i + length], s.anchor - i) == s.anchor - i


def test_blocks_do_not_change_segments(monkeypatch):
    texts = [t.encode() for t in corpus(5, 6, 900, 2)]
    whole = list(repeats.segments(texts))
    monkeypatch.setattr(repeats, "BLOCK", 333)
    assert list(repeats.segments(texts)) == whole


def test_only_segments_whose_anchor_is_asked_for_are_hashed_as_a_whole(monkeypatch):
    rng = random.Random(11)
    text = bytes(rng.choices(b"abcdefgh", k=5_000))
    ((row,),) = [batch.column("row").unique().to_pylist() for batch in repeats._signed(200)(iter([_rows([7], [text])]))]
    keys = [(x["h"], x["c"], x["n"]) for batch in repeats._signed(200)(iter([_rows([7], [text])])) for x in batch.to_pylist()]
    assert row == 7 and len(keys) > 20 and all(n == 1 for *_, n in keys)
    hashed = []
    digest = repeats.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(repeats.xxhash, "xxh3_64_intdigest", lambda data, *seed: hashed.append(len(data)) or digest(data, *seed))
    h, c, _ = keys[5]
    asked = pa.array([[{"h": h, "c": c, "n": 1, "size": 2}]])
    (batch,) = repeats._fetched(200)(iter([_rows([7], [text], asked)]))
    (found,) = batch.to_pylist()
    assert (found["h"], found["c"], found["size"]) == (h, c, 2) and found["bytes"] in text
    assert sum(size >= 200 for size in hashed) == 1


def _rows(rows, texts, *more):
    columns = [pa.array(rows, pa.int64()), pa.array(texts, pa.binary()), *more]
    return pa.RecordBatch.from_arrays(columns, ["row", "text", "asked"][: len(columns)])
