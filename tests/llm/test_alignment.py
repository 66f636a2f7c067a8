"""Alignment of two tokenizers against the libraries and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickmill.llm import alignment
from clickmill.llm.common import table
from clickmill.llm.tokens import piece_encoder

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b   c    ", "\n", "\t\ta\r\n b", "x" * 300, "<s> </s> <unk> <|endoftext|><|endoftext|> <0x41>",
    "nul \0 byte", "one▁two", "▁", "é ﬁ Å K ß İ", "日本語のテキスト 漢字", "😀😀 🏳️‍🌈", "12345 3.14 -7", "'s don't it's", "    　",
    "Hello, world! Hello, world!", "ab" * 50, "á ​ x",
]


def library_tokens(text):
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in visible}
    signs |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in visible)}
    a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = pieces.encode(text)
    bytes_a = [bytes(signs[c] for c in tokenizer.id_to_token(i)) for i in a]
    bytes_b = []
    for i in b:
        name = pieces.id_to_piece(i)
        bytes_b.append(bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode())
    return a, b, bytes_a, bytes_b


def expected(rows):
    """One row per text by plain loops over the libraries' tokens."""
    found, counts = [], Counter()
    for doc_id, text in rows:
        links, groups, a, b = [], [], [], []
        if text:
            a, b, bytes_a, bytes_b = library_tokens(text)
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_a = {int(e): i for i, e in enumerate(np.cumsum([len(t) for t in bytes_a]))}
                ends_b = {int(e): i for i, e in enumerate(np.cumsum([len(t) for t in bytes_b]))}
                at_a = at_b = 0
                for end in sorted(ends_a.keys() & ends_b.keys()):
                    i, j = ends_a[end], ends_b[end]
                    links.append((a[i], b[j]))
                    groups.append(",".join(map(str, a[at_a : i + 1])) + "|" + ",".join(map(str, b[at_b : j + 1])))
                    at_a, at_b = i + 1, j + 1
            else:
                a = b = []
        counts.update(links)
        found.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if links else ""))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (doc_id, a, b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha)
        for doc_id, a, b, links, sha in found
    )


def check(frame, rows):
    assert sorted(map(tuple, alignment.alignment(frame, A, B).collect())) == expected(rows)


def test_alignment_equals_plain_loops(documents):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(100, None), (101, ODD[16] * 3), (102, "words " * 5000), (103, "a"), (103, "a"), (103, " b")]
    check(documents(*rows), rows)


def test_alignment_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_alignment_of_nothing_and_with_other_columns(spark, documents):
    assert alignment.alignment(documents(), A, B).count() == 0
    assert [tuple(r) for r in alignment.alignment(documents((None, None)), A, B).collect()] == [(None, 0, 0, 0, 0, 0, 0, "")]
    clashing = spark.createDataFrame([(1, "some text", 5, "x", [1])], "doc_id int, text string, row int, pairs string, mapped array<int>")
    check(clashing, [(1, "some text")])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab .\n\t  ▁é日Ω0'<s>") | st.characters(codec="utf-8"), min_size=1, max_size=40))
def test_pieces_in_parts_are_those_of_the_library(text):
    ids = piece_encoder(B).encode([b" " + text.encode()])[0]
    whole = sentencepiece.SentencePieceProcessor(model_file=B).encode(text)
    if "▁" not in text:
        assert np.frombuffer(ids, "<u4").tolist() == whole


def test_identity_map_holds_equal_bytes():
    a, b = alignment.byte_tokens(A), alignment.piece_tokens(B)
    identity = alignment.identity_map(A, B)
    assert all(a[i] == b[j] for i, j in enumerate(identity.tolist()) if j >= 0)
    assert (identity >= 0).sum() > 10_000
    assert all(a[:50_256])
    assert sum(not token for token in b) == 2
