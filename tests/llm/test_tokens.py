"""Token files and packing against the tokenizer library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickmill.llm import packing, token_files, tokens
from clickmill.llm.common import new_path, table
from clickmill.llm.tokens import PartEncoder

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "a  b", "a   b", "a \n b", "\n\n a", "don't 's it's,'s", "x <|endoftext|> y<|endoftext|>z", "A <|STARTOFTEXT|> <|startoftext|>",
    "İstanbul ΣΑΣ ς", "é ́x", "a\x0bb \x0cc\x1cd \x1d e \x85f \xa0g", "tab\t x \ty", "end ", " start", "12 345 6,7", "word,'ll it",
    "日本 語 　 x", "a   b", "ﬁ Å K", "a\r\n b", "9th é, ÀÉ: ß;", "a (b) [c] {d} <e> «f» “g”", "xn--<|endoftext|>, <|endoftext|>.",
]


@pytest.mark.parametrize(("path", "spaced"), [(WORDS, False), (BYTES, True)])
def test_ids_are_those_of_the_library(path, spaced):
    ours, library = PartEncoder(path, spaced), Tokenizer.from_file(path)
    for _ in range(2):  # the second time from what is kept
        for text, ids in zip(ODD, ours.encode([t.encode() for t in ODD]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize(("path", "spaced"), [(WORDS, False), (BYTES, True)])
def test_ids_of_mixed_texts_are_those_of_the_library_when_the_cache_overflows(path, spaced, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PARTS", 40)
    monkeypatch.setattr(tokens, "CORE_PARTS", 10)
    draw = random.Random(5)
    signs = ["&&&", ".", ".***", "%", ")", "'s", "'", '"', "-", "<", "|>", "<|endoftext|>", ">", "\u2026", "\u201d", "_", "\\", "~", "{}", "/", ":;"]
    blanks = [" ", " ", " ", "\n", "\n", "  ", "\n\n", " \n", "\t", "\xa0", "\u2028", "\u3000", "\x85", "\x1c", ""]
    words = ["word", "Wort", "\xe9t\xe9", "co\xfb", "7", "x\xd7", "\u0391\u03b8", "\u65e5\u672c", "a", "It", "", "\xf7"]
    texts = ["".join(draw.choice(x) for _ in range(30) for x in (words, signs + [""] * 20, blanks)) for _ in range(300)]
    ours, library = PartEncoder(path, spaced), Tokenizer.from_file(path)
    for at in range(0, len(texts), 20):
        part = texts[at : at + 20]
        for text, ids in zip(part, ours.encode([t.encode() for t in part]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_signs_and_line_ends_make_no_new_parts():
    ours = PartEncoder(BYTES, True)
    ours.encode(["\xe9t\xe9 word&&& Next\nword.\nNext &&&".encode()])
    assert {b"word", b"\0&&&", b"\0\n", b"\0Next", b"\0."} <= set(ours.known)
    known = len(ours.known)
    ours.encode(["word. word\nNext&&& \xe9t\xe9.\nNext word&&&".encode()])
    assert set(list(ours.known)[known:]) <= {b"\0word", "\xe9t\xe9".encode()}


def test_a_full_cache_keeps_its_first_parts(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PARTS", 4)
    monkeypatch.setattr(tokens, "CORE_PARTS", 2)
    ours = PartEncoder(BYTES, True)
    ours.encode([b"a b c d e f"])
    first = list(ours.known)[:2]
    ours.encode([b"g h"])
    assert list(ours.known)[:2] == first and len(ours.known) <= 2 + 2


def expected(rows, path, end):
    library = Tokenizer.from_file(path)
    return [(d, np.array([*library.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for d, t in rows]


def check_files(df, rows):
    at, wanted = 0, []
    for doc_id, ids in sorted(expected(rows, WORDS, 2), key=lambda r: (r[0] is not None, r[0] or 0)):
        wanted.append((doc_id, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(wanted, key=str)


def test_token_files_read_back_what_was_encoded(documents):
    rows = [(7, "some words here"), (3, None), (5, ""), (5, ""), (None, "no id"), (9, "long " * 30_000), (2, "a")]
    check_files(token_files.token_files(documents(*rows), WORDS), rows)


def test_token_files_of_nothing_and_with_other_columns(spark, documents):
    assert token_files.token_files(documents(), WORDS).count() == 0
    clashing = spark.createDataFrame([(1, "a b", 5, 6, "x")], "doc_id bigint, text string, start bigint, ids bigint, file string")
    check_files(token_files.token_files(clashing, WORDS), [(1, "a b")])


def test_token_files_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check_files(token_files.token_files(docs, WORDS), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_many_rows_of_one_document_and_several_files_of_a_task(spark, documents):
    rows = [(None if i % 3 == 0 else i, f"text {i % 50} " * (i % 7)) for i in range(400)]
    kept = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        found = token_files.token_files(documents(*rows).repartition(5), WORDS).collect()
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", kept)
    # The rows in the order of their starts fill the ids without a gap, doc_ids ascend, and each row has its own ids.
    found = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in found] == [0, *np.cumsum([r["n_tokens"] for r in found])[:-1].tolist()]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert ids == sorted(ids)
    wanted = sorted(((d, len(one), zlib.crc32(one)) for d, one in expected(rows, WORDS, 2)), key=str)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found), key=str) == wanted


def test_files_ascend_and_prune_by_document(spark, documents):
    folder = new_path(spark, "token-files")
    token_files.write_token_files(documents(*[(i, f"text {i}") for i in range(200)]), folder, WORDS)
    held = token_files.read_token_files(spark, folder)
    ids = [r["doc_id"] for r in held.orderBy("file", "local_start").select("doc_id").collect()]
    assert ids == list(range(200))
    plan = held.filter("doc_id = 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,5)" in plan


def check_packing(df, rows, capacity=2048):
    ids = defaultdict(list)
    for doc_id, one in expected(rows, BYTES, 0):
        ids[doc_id].append(one)
    found, sequences, used = df.collect(), defaultdict(list), 0
    for row in found:
        assert any(zlib.crc32(one[row["start"] : row["start"] + row["length"]]) == row["ids_crc32"] for one in ids[row["doc_id"]])
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
        used += row["length"]
    assert used == sum(len(one) for many in ids.values() for one in many)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-used // capacity)


def test_packing_places_every_piece_once(documents):
    rows = [(1, "word " * 5_000), (2, None), (3, ""), (3, ""), (None, "no id"), (4, "a b c"), (5, "x " * 700), (6, "x " * 700)]
    sequences, least = check_packing(packing.packed_documents(documents(*rows), BYTES), rows)
    assert sequences == least
    pieces = packing.token_pieces(documents(rows[0]), BYTES).orderBy("piece").collect()
    assert [p["length"] for p in pieces[1:]] == [2048] * (len(pieces) - 1) and pieces[0]["length"] <= 2048


def test_packing_of_nothing_and_of_the_table(spark, documents, sf_dir):
    assert packing.packed_documents(documents(), BYTES).count() == 0
    docs = table(spark, sf_dir, "documents").withColumnRenamed("n_chars", "length")
    sequences, least = check_packing(packing.packed_documents(docs, BYTES), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sequences <= least + 1


@pytest.mark.parametrize("n", [1, 50, 5_000, 60_000])
def test_plan_nearly_reaches_the_bound(n):
    lengths = np.minimum(np.exp(np.random.default_rng(n).normal(6.2, 1, n)).astype(int) + 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    plan = packing.packing_plan(counts)
    assert plan.sequences <= 1.005 * -(-lengths.sum() // 2048) + 1
    ends = {}
    for length, rank, _, _, _ in sorted(plan.runs):
        assert rank >= ends.get(length, 0)
        ends[length] = rank
