"""Alignment of two tokenizers over a corpus, with an identity map as the fast path.

Every text is encoded by a byte-level vocabulary (A, with a space before the text) and by a piece vocabulary (B, which adds that
space itself). The byte offsets at which tokens of both end cut the text into groups, and the last tokens of each group's two
sides are linked. How often each pair of ids is linked in the corpus is counted on two ways:

* An id of A whose bytes are also an id of B has that id in the identity map, an array made once from the vocabularies. A
  group of one token on either side that agrees with the map is counted in a vector as long as the vocabulary, one per task,
  whatever the number of its rows. No other group links such a pair: tokens with equal bytes that end together also start
  together, so they are a group of their own.
* Only the other groups' pairs are shuffled, counted per text and per task before.

Vectors over a vocabulary (the counts of the map, the highest count of each id of B) are the only things that reach the driver
or are sent to all tasks, besides pairs that make more than 1/20,000 of all links (``common.joined_counted``).

Defined results: a text that is null or empty, or whose joined token bytes differ from the space and the text (it holds the
sign that stands for a blank, say), has no tokens: zeros, and groups_sha256 is ''. Every row gets its own result, also rows with
the same or a null doc_id. Names of special tokens in a text are plain text. An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clickmill.llm.common import discard, joined_counted, stored
from clickmill.llm.tokens import BLANK_SIGN, encoder, piece_encoder, portions, text_bytes

# A pair of ids as one number: the id of A times this, and the id of B.
PAIR = 1 << 32
_COLUMNS = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "mapped array<int>, mapped_n array<int>, pairs array<bigint>, pairs_n array<int>"
)


def _byte_signs() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: visible Latin-1 signs as themselves, the others from U+0100 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(0x100 + i): byte for i, byte in enumerate(hidden)}


@cache
def byte_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; special tokens, which no text has, are empty."""
    tokenizer, signs = Tokenizer.from_file(path), _byte_signs()
    special = {i for i, token in tokenizer.get_added_tokens_decoder().items() if token.special}
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [b"" if i in special else bytes(signs[sign] for sign in name) for i, name in enumerate(names)]


@cache
def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a piece vocabulary; control pieces, which no text has, are empty."""
    pieces = SentencePieceProcessor(model_file=path)

    def token(number: int) -> bytes:
        name = pieces.id_to_piece(number)
        if pieces.is_byte(number):
            return bytes([int(name[3:5], 16)])
        return b"" if pieces.is_control(number) else name.replace(BLANK_SIGN, " ").encode()

    return [token(i) for i in range(pieces.get_piece_size())]


def identity_map(path_a: str, path_b: str) -> np.ndarray:
    """For each id of A the id of B with the same bytes, or -1; of several the last one, a piece before a single byte."""
    ids = {token: number for number, token in enumerate(piece_tokens(path_b)) if token}
    return np.array([ids.get(token, -1) for token in byte_tokens(path_a)], np.int64)


@cache
def _vocabularies(path_a: str, path_b: str):
    """Tokens and their lengths of both sides, the identity map, and every id as text with what may follow it."""
    a, b = byte_tokens(path_a), piece_tokens(path_b)
    lengths = [np.array([len(token) for token in side], np.int64) for side in (a, b)]
    # An id of A is followed by a comma or, at the end of its side, a bar; one of B by a comma or a semicolon.
    written = [b"%d%c" % (i, sign) for count, signs in ((len(a), b",|"), (len(b), b",;")) for i in range(count) for sign in signs]
    return a, b, *lengths, identity_map(path_a, path_b), written


def _last(sizes: np.ndarray, total: int) -> np.ndarray:
    """1 at the last place of each group."""
    found = np.zeros(total, np.int64)
    found[np.cumsum(sizes) - 1] = 1
    return found


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def aligned_text(text: bytes, a: np.ndarray, b: np.ndarray, path_a: str, path_b: str):
    """(number of groups, hash of the groups, mapped ids of A, pairs of the other groups), or None without tokens."""
    tokens_a, tokens_b, length_a, length_b, identity, written = _vocabularies(path_a, path_b)
    ends_a, ends_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
    whole = b" " + text
    if not len(a) or not len(b) or ends_a[-1] != len(whole) or ends_b[-1] != len(whole):
        return None
    if b"".join(map(tokens_a.__getitem__, a.tolist())) != whole or b"".join(map(tokens_b.__getitem__, b.tolist())) != whole:
        return None
    at = np.searchsorted(ends_b, ends_a)
    last_a = np.flatnonzero(ends_b[at] == ends_a)
    last_b = at[last_a]
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    link_a, link_b = a[last_a], b[last_b]
    mapped = (size_a == 1) & (size_b == 1) & (identity[link_a] == link_b)
    # The ids of a group's first side stand before those of its second: each token moves behind those of the other side.
    order = np.empty(len(a) + len(b), np.int64)
    group_a, group_b = np.repeat(np.arange(len(size_a)), size_a), np.repeat(np.arange(len(size_b)), size_b)
    order[np.arange(len(a)) + (last_b + 1 - size_b)[group_a]] = 2 * a + _last(size_a, len(a))
    order[np.arange(len(b)) + (last_a + 1)[group_b]] = 2 * (len(tokens_a) + b) + _last(size_b, len(b))
    groups = b"".join(map(written.__getitem__, order.tolist()))[:-1]
    return len(last_a), hashlib.sha256(groups).hexdigest(), link_a[mapped], (link_a * PAIR + link_b)[~mapped]


def _aligned(path_a: str, path_b: str):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours, theirs = encoder(path_a, True, plain=True), piece_encoder(path_b)
        for batch in portions(batches):
            texts = text_bytes(batch.column(1))
            spaced = [b" " + text for text in texts if text]
            ids = zip(ours.encode(spaced), theirs.encode(spaced), strict=True)
            rows = []
            for text in texts:
                a, b = (np.frombuffer(x, "<u4").astype(np.int64) for x in next(ids)) if text else (np.empty(0, np.int64),) * 2
                found = aligned_text(text, a, b, path_a, path_b)
                if found is None:
                    rows.append((0, 0, 0, "", *[np.empty(0, np.int64)] * 4))
                else:
                    number, sha, mapped, pairs = found
                    rows.append((len(a), len(b), number, sha, *_counted(mapped), *_counted(pairs)))
            n_a, n_b, n_groups, sha, *lists = zip(*rows, strict=True)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32())
            columns = [batch.column(0), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_groups)], pa.array(sha)]
            columns += [_lists(values, kind) for values, kind in zip(lists, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _COLUMNS.split(", ")])

    return aligned


def _lists(values: tuple[np.ndarray, ...], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(values), kind))


def _flat(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _map_counts(size: int):
    """id, n: the task's counts of mapped ids, from one vector as long as the vocabulary."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            np.add.at(total, _flat(batch, 0), _flat(batch, 1))
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids])], ["id", "n"])

    return counts


def _map_sums(totals: np.ndarray, best: np.ndarray):
    """row, n_best, count_sum of the mapped links of each text."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            text, ids, n = np.repeat(np.arange(batch.num_rows), sizes), _flat(batch, 1), _flat(batch, 2)
            found = []
            for values in (n * best[ids], n * totals[ids]):
                ends = np.concatenate([[0], np.cumsum(values)])
                starts = np.searchsorted(text, np.arange(batch.num_rows + 1))
                found.append(pa.array(np.diff(ends[starts])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["row", "n_best", "count_sum"])

    return sums


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of doc_id, text."""
    identity = identity_map(path_a, path_b)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    aligned = texts.mapInArrow(_aligned(path_a, path_b), _COLUMNS).withColumn("row", F.monotonically_increasing_id())
    aligned = stored(aligned, "aligned")

    # Mapped links: a number for each id of A; at most as many rows as the vocabulary reach the driver.
    mapped = aligned.select("mapped", "mapped_n").mapInArrow(_map_counts(len(identity)), "id int, n bigint")
    totals = np.zeros(len(identity), np.int64)
    for number, n in mapped.groupBy("id").agg(F.sum("n")).collect():
        totals[number] = n

    # Other links: pairs, counted per text, per task and then per pair.
    links = stored(aligned.select("row", F.explode(F.arrays_zip("pairs", "pairs_n")).alias("p")).select("row", "p.pairs", "p.pairs_n"), "links")
    counted = stored(links.groupBy("pairs").agg(F.sum("pairs_n").alias("count"), F.count(F.lit(1)).alias("rows")), "pairs")
    b = (F.col("pairs") % PAIR).cast("int").alias("b")
    best = np.zeros(len(piece_tokens(path_b)), np.int64)
    for number, n in counted.groupBy(b).agg(F.max("count")).collect():
        best[number] = n
    known = identity >= 0
    np.maximum.at(best, identity[known], totals[known])

    highest = docs.sparkSession.createDataFrame([(i, n) for i, n in enumerate(best.tolist()) if n], "b int, highest bigint")
    ranked = counted.withColumn("b", b).join(F.broadcast(highest), "b")
    ranked = ranked.select("pairs", "count", "rows", (F.col("count") == F.col("highest")).cast("bigint").alias("is_best"))
    joined = joined_counted(links, ranked, ["pairs"], "rows", links.count())
    n = F.col("pairs_n").cast("bigint")
    irregular = joined.select("row", (n * F.col("is_best")).alias("n_best"), (n * F.col("count")).alias("count_sum"))
    is_best = np.where(known, totals == best[identity], False).astype(np.int64)
    regular = aligned.select("row", "mapped", "mapped_n").mapInArrow(_map_sums(totals, is_best), "row bigint, n_best bigint, count_sum bigint")
    sums = regular.unionByName(irregular).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = stored(aligned.drop("mapped", "mapped_n", "pairs", "pairs_n").join(sums, "row"), "alignment")
    for frame in (links, counted, aligned):
        discard(frame)
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
