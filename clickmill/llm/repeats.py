"""Removal of byte strings that recur anywhere in a corpus, by run-length compressed indexes of anchored segments.

A window is ``length`` neighbouring bytes of one text. The window's anchor is the leftmost of its KMERs with the smallest hash,
so equal windows have equal anchors at the same place, and every window has exactly one. The windows of a text that share an
anchor form a segment, their bytes; each window is in one segment, and equal windows are in segments with the same anchor bytes.

1. Texts are stored in buckets by row number. Each text sends (anchor hash, segment hash, number) of its segments.
2. Equal segments are counted before anything else, so a group of copies is one segment with a number, however large. A
   segment that occurs twice is removed as a whole. An anchor that occurs once drops out.
3. What is left are single segments whose anchor has other segments too: places where a repeated passage begins, ends or was
   edited. Their bytes, and those of the segments they meet, are brought together by anchor, and a task builds one index of
   each portion of whole groups: suffixes are sorted, the Burrows-Wheeler transform is cut into runs of equal letters, and the
   common prefix with the neighbour is measured only at the ends of runs. Matching statistics are streamed through the text
   from these samples (one place further on, a match inside of a run is one byte shorter), and windows whose match with another
   place is ``length`` or more are marked.
4. A group with more than LARGEST different segments (a passage after which thousands of texts go on differently) is not indexed
   as it is: its windows are halved by their distance from the anchor, and each half is grouped by the bytes that all of its
   windows share. Equal pieces are counted again; at the latest a single window is left, whose group is one piece. So at most
   eight halvings settle a group of any size, and no task holds more than LARGEST segments of a group.
5. Marks go back to the texts, which find their segments again and cut the marked bytes.

Hot anchors, segments and pieces are counted with partial sums and joined by ``common.joined_counted``; no task holds a whole group.

Defined results: null is the empty text; texts shorter than ``length`` keep everything; every row is a text of its own, so
texts that occur twice lose every window, also under one doc_id or a null one. An empty table gives no rows; further columns
are ignored. Offsets are bytes of UTF-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import bucketed, discard, drop_table, joined_counted, stored
from clickmill.llm.tokens import portions, text_bytes

LENGTH = 200
# Different segments of an anchor that are indexed together; larger groups are halved.
LARGEST = 2048
# Bytes of whole groups in one index.
INDEX_BYTES = 1 << 18
# Window starts that are looked at together in a long text.
BLOCK = 1 << 16
# Symbols of 9 bits in the first key of a suffix.
PACKED = 7


class Segment(NamedTuple):
    """Window starts ``first`` to ``last`` of a text that share the anchor at ``anchor``."""

    text: int
    anchor: int
    first: int
    last: int


def kmer_size(length: int) -> int:
    """The largest power of two up to a third of the window."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def _kmer_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 32-bit hash of every ``size`` neighbouring bytes, by doubling."""
    value = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    factor, step = 0x85EBCA6B, 1
    while step < size:
        value = value[:-step] * np.uint32(factor) + value[step:]
        factor, step = factor * factor % (1 << 32), 2 * step
    value ^= value >> np.uint32(16)
    value *= np.uint32(0xC2B2AE35)
    value ^= value >> np.uint32(13)
    return value


def _sliding(values: np.ndarray, width: int, extreme) -> np.ndarray:
    """The extreme of every ``width`` neighbouring values, by doubling."""
    step = 1
    while 2 * step <= width:
        values = extreme(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return extreme(values[:-rest], values[rest:]) if rest else values


def _anchors(data: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """The anchor of every valid window, -1 for the others."""
    size = kmer_size(length)
    hashes = _kmer_hashes(data, size)
    # Hash and place in one number, so the smallest one of a window is its leftmost KMER with the smallest hash.
    numbered = (hashes.astype(np.uint64) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding(numbered, length - size + 1, np.minimum)
    return np.where(valid, (least & np.uint64(0xFFFFFFFF)).astype(np.int64), -1)


def _places(texts: list[bytes], length: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one string; of all segments their text, anchor, first and last window there, and where their text starts."""
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    whole = b"".join(texts)
    data = np.frombuffer(whole, np.uint8)
    valid = np.ones(max(0, len(data) - length + 1), bool)
    for end, start in zip(starts[1:].tolist(), starts[:-1].tolist(), strict=True):
        valid[max(start, end - length + 1) : end] = False
    anchors = np.empty(len(valid), np.int64)
    for block in range(0, len(valid), BLOCK):
        part = _anchors(data[block : block + BLOCK + length - 1], valid[block : block + BLOCK], length)
        anchors[block : block + BLOCK] = np.where(part >= 0, part + block, -1)
    # A text's last windows are not valid, so neighbours of two texts are never one segment.
    firsts = np.flatnonzero(np.diff(anchors, prepend=-1) != 0)
    lasts = np.append(firsts[1:], len(anchors)) - 1
    real = anchors[firsts] >= 0
    firsts, lasts = firsts[real], lasts[real]
    of = np.searchsorted(starts, firsts, side="right") - 1
    return whole, of, anchors[firsts], firsts, lasts, starts[of]


def segments(texts: list[bytes], length: int = LENGTH) -> Iterator[Segment]:
    """All segments of all texts, by text and place."""
    _, of, anchors, firsts, lasts, base = _places(texts, length)
    for values in zip(of.tolist(), (anchors - base).tolist(), (firsts - base).tolist(), (lasts - base).tolist(), strict=True):
        yield Segment(*values)


def _signed_hash(data: bytes, seed: int = 0) -> int:
    value = xxhash.xxh3_64_intdigest(data, seed)
    return value - (1 << 64) if value >> 63 else value


def _hashes(whole: bytes, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The signed hashes of the parts of a string."""
    digest = xxhash.xxh3_64_intdigest
    found = [digest(whole[a:b]) for a, b in zip(firsts.tolist(), ends.tolist(), strict=True)]
    return np.array(found, np.uint64).view(np.int64)


def _asked_segments(texts: list[bytes], asked: list[list[dict]], length: int) -> Iterator[tuple[Segment, int, int, dict]]:
    """The segments of each text that it is asked for, with the hashes of their anchor and of the whole, and what asks for them."""
    whole, of, anchors, firsts, lasts, base = _places(texts, length)
    wanted = {(text, x["h"], x["c"]): x for text, found in enumerate(asked) for x in found}
    h = _hashes(whole, anchors, anchors + kmer_size(length))
    # The whole is read only where the anchor is asked for.
    near = np.flatnonzero(np.isin(h, np.fromiter((key[1] for key in wanted), np.int64, len(wanted))))
    of, h, anchors, firsts, lasts, base = (x[near] for x in (of, h, anchors, firsts, lasts, base))
    c = _hashes(whole, firsts, lasts + length)
    places = ((anchors - base).tolist(), (firsts - base).tolist(), (lasts - base).tolist())
    for text, anchor_hash, whole_hash, *place in zip(of.tolist(), h.tolist(), c.tolist(), *places, strict=True):
        if found := wanted.get((text, anchor_hash, whole_hash)):
            yield Segment(text, *place), anchor_hash, whole_hash, found


def _batch(columns, schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    fields = [field.split() for field in schema.split(", ")]
    arrays = [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _columns(rows: list[tuple], schema: str):
    return list(zip(*rows, strict=True)) if rows else [()] * (schema.count(",") + 1)


_SIGNED = "row bigint, h bigint, c bigint, n bigint"


def _signed(length: int):
    """The segments of each text, equal ones counted."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            whole, of, anchors, firsts, lasts, _ = _places(text_bytes(batch.column(1)), length)
            keys = [of, _hashes(whole, anchors, anchors + kmer_size(length)), _hashes(whole, firsts, lasts + length)]
            order = np.lexsort(keys)
            of, h, c = (key[order] for key in keys)
            new = np.flatnonzero(np.concatenate([[True], (np.diff(of) != 0) | (np.diff(h) != 0) | (np.diff(c) != 0)])[: len(of)])
            row = batch.column(0).to_numpy()[of[new]]
            yield _batch([row, h[new], c[new], np.diff(new, append=len(of))], _SIGNED)

    return signed


# A piece: its group, its own hash, number and the size of the group, the first distance from the anchor's start to a window's
# start and the last one that the group holds, the distance of its own first window, and its bytes.
_PIECES = "h bigint, c bigint, n bigint, size bigint, low int, high int, distance int, bytes binary"


def _fetched(length: int):
    """The asked segments of each text with their bytes. A segment's windows start ``distance`` bytes before the anchor and less."""

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            texts, seen, rows = text_bytes(batch.column(1)), set(), []
            for segment, h, c, found in _asked_segments(texts, batch.column(2).to_pylist(), length):
                if (segment.text, h, c) not in seen:
                    seen.add((segment.text, h, c))
                    data = texts[segment.text][segment.first : segment.last + length]
                    rows.append((h, c, found["n"], found["size"], 0, length - kmer_size(length), segment.anchor - segment.first, data))
            yield _batch(_columns(rows, _PIECES), _PIECES)

    return fetched


_HALVES = "h bigint, c bigint, n bigint, origin_h bigint, origin_c bigint, shift int, low int, high int, distance int, bytes binary"


def _halved(length: int):
    """Each piece in up to two pieces, grouped by the bytes that all windows of a half share."""

    def halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, c, n, low, high, distance, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                middle = (low + high) // 2
                nearest = distance - (len(data) - length)
                for least, most in ((low, middle), (middle + 1, high)):
                    a, b = min(distance, most), max(nearest, least)
                    if a < b or least > most:
                        continue
                    # Bytes by their place in the piece: its windows start at distance - a to distance - b.
                    part = data[distance - a : distance - b + length]
                    core = data[distance - least : distance - most + length]
                    group = _signed_hash(core, hash((h, least, most)) % (1 << 63))
                    rows.append((group, _signed_hash(part), n, h, c, distance - a, least, most, a, part))
            yield _batch(_columns(rows, _HALVES), _HALVES)

    return halved


class RunIndex:
    """The run-compressed transform of several byte strings, with the common prefixes at the ends of its runs.

    Every string ends with a mark of its own, smaller than all bytes, so suffixes are different within one string's length.
    """

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) + 1 for s in strings], np.int64)
        ends = np.cumsum(sizes) - 1
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
        text[ends] = 0
        self.text, self.ends, self.size = text, ends, len(text)
        self.string = np.repeat(np.arange(len(strings)), sizes)
        # Symbols from each place up to the mark, which counts.
        self.left = ends[self.string] - np.arange(self.size) + 1
        self.levels: list[tuple[int, np.ndarray]] = []
        order = self._sorted()
        letters = text[order - 1]
        # A mark is a letter of its own; the letter before the whole text is the last mark.
        same = (letters[1:] == letters[:-1]) & (letters[1:] != 0)
        self.run_starts = np.flatnonzero(np.concatenate([[True], ~same]))
        ends_of_runs, starts_of_runs = order[self.run_starts[1:] - 1], order[self.run_starts[1:]]
        shared = self._common_prefix(ends_of_runs, starts_of_runs)
        # Samples: places in the text at the starts and ends of runs, with their match with the neighbour beyond.
        self.before = self._sampled(np.append(order[0], starts_of_runs), np.append(0, shared))
        self.after = self._sampled(np.append(ends_of_runs, order[-1]), np.append(shared, 0))

    def _sorted(self) -> np.ndarray:
        """The suffixes in order, by doubling; ranks at each length are kept for common prefixes."""
        n, here = self.size, np.arange(self.size)
        padded = np.concatenate([self.text, np.zeros(PACKED, np.int64)])
        key = np.zeros(n, np.int64)
        for step in range(PACKED):
            key = (key << 9) | np.where(self.left > step, padded[step : step + n], 0)
        # Equal keys that hold a mark are told apart by their strings, which ascend with the places.
        length, order = PACKED, np.argsort(key, kind="stable")
        marked = (self.left <= PACKED)[order]
        while True:
            ranked = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], (ranked[1:] != ranked[:-1]) | marked[1:]]))
            self.levels.append((length, rank))
            if rank[order[-1]] == n - 1:
                return order
            # A suffix that ends within this length is known by its rank.
            key = rank * n + np.where(self.left > length, rank[np.minimum(here + length, n - 1)], 0)
            length, order = 2 * length, np.argsort(key)
            marked = np.zeros(n, bool)

    def _common_prefix(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of equal symbols from each place of ``left`` and ``right``; marks are equal to nothing."""
        total = np.zeros(len(left), np.int64)
        last = self.size - 1
        for length, rank in reversed(self.levels):
            a, b = np.minimum(left + total, last), np.minimum(right + total, last)
            total += np.where(rank[a] == rank[b], length, 0)
        going = np.ones(len(left), bool)
        for _ in range(PACKED):
            a, b = self.text[np.minimum(left + total, last)], self.text[np.minimum(right + total, last)]
            going &= (a == b) & (a != 0)
            total += going
        return total

    def _sampled(self, places: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(places)
        return places[order], lengths[order]

    def matching_statistics(self) -> np.ndarray:
        """For each place the longest match with any other place, streamed from the samples through the text."""
        here = np.arange(self.size)
        found = np.zeros(self.size, np.int64)
        for places, lengths in (self.before, self.after):
            sample = np.searchsorted(places, here, side="right") - 1
            known = sample >= 0
            found[known] = np.maximum(found[known], (lengths[sample] - (here - places[sample]))[known])
        return found

    def marked(self, length: int) -> list[list[int]]:
        """For each string the first and last place of each run of windows that also occur elsewhere, in turn."""
        hit = (self.matching_statistics() >= length) & (self.left > length)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        starts = self.ends + 1 - np.diff(self.ends, prepend=-1)
        found: list[list[int]] = [[] for _ in self.ends]
        # The mark after each string is never hit, so no run crosses strings.
        for first, after in edges.reshape(-1, 2).tolist():
            string = int(self.string[first])
            found[string] += [first - int(starts[string]), after - 1 - int(starts[string])]
        return found


_MARKS = "h bigint, c bigint, marks array<int>"


def _indexed(length: int):
    """Marks of single segments, from rows in the order of their groups; an index holds whole groups."""

    def marks(rows: list[tuple]) -> pa.RecordBatch:
        found = RunIndex([data for *_, data in rows]).marked(length)
        kept = [(h, c, mark) for (h, c, n, _), mark in zip(rows, found, strict=True) if n == 1 and mark]
        return _batch(_columns(kept, _MARKS), _MARKS)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held >= INDEX_BYTES and row[0] != waiting[-1][0]:
                    yield marks(waiting)
                    waiting, held = [], 0
                waiting.append(row)
                held += len(row[3])
        if waiting:
            yield marks(waiting)

    return indexed


def _index(pieces: DataFrame, length: int) -> DataFrame:
    """h, c, marks of the single pieces of groups of at most LARGEST."""
    small = pieces.filter(F.col("size") <= LARGEST).select("h", "c", "n", "bytes")
    return small.repartition("h").sortWithinPartitions("h", "c").mapInArrow(_indexed(length), _MARKS)


def _grouped(pieces: DataFrame, total: int) -> DataFrame:
    """The different pieces (h, c, n) that are not alone under their h, with the number of pieces of their group.

    Groups whose pieces all occur twice need no index, as do those of one piece: their ``single`` is 0 or their size 1.
    """
    groups = pieces.groupBy("h").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("all"), F.sum((F.col("n") == 1).cast("bigint")).alias("single")
    )
    return joined_counted(pieces, groups.filter("all > 1").drop("all"), ["h"], "size", total)


def _to_index() -> Column:
    return (F.col("size") > 1) & (F.col("single") > 0)


def _single_marks(pieces: DataFrame, length: int, made: list[DataFrame]) -> DataFrame:
    """h, c, marks of the pieces that occur once and have marked windows; adds the tables it needs to ``made``."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        made.append(stored(df, name))
        return made[-1]

    found = _index(pieces, length)
    large = pieces.filter(F.col("size") > LARGEST)
    if large.isEmpty():
        return found
    columns = ["h", "c", "n", "low", "high", "distance", "bytes"]
    halves = kept(large.select(*columns).mapInArrow(_halved(length), _HALVES), "halves")
    different = halves.groupBy("h", "c").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("parts"),
        *[F.min(name).alias(name) for name in ("low", "high", "distance", "bytes")],
    )
    different = kept(different, "different")
    grouped = kept(_grouped(different, different.count()), "grouped")
    inner = _single_marks(kept(grouped.filter(_to_index()).drop("single", "parts"), "pieces"), length, made)
    whole = grouped.filter("n > 1").select(
        "h", "c", "parts", F.array(F.lit(0), (F.length("bytes") - length).cast("int")).alias("marks")
    )
    verdicts = kept(whole.unionByName(inner.withColumn("parts", F.lit(1).cast("bigint"))), "verdicts")
    joined = joined_counted(halves.select("h", "c", "n", "origin_h", "origin_c", "shift"), verdicts, ["h", "c"], "parts", halves.count())
    shifted = F.transform("marks", lambda place: place + F.col("shift"))
    outer = joined.filter("n = 1").groupBy(F.col("origin_h").alias("h"), F.col("origin_c").alias("c"))
    return found.unionByName(outer.agg(F.flatten(F.collect_list(shifted)).alias("marks")))


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs that the ranges (start, end) cover."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


_CUT = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def _cut(length: int):
    """The marked runs of each text, and its bytes without them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in portions(batches):
            texts, found = text_bytes(batch.column(1)), batch.column(2).to_pylist()
            marked = [one or [] for one in found]
            touched = [text if marks else b"" for text, marks in zip(texts, marked, strict=True)]
            ranges: list[list[tuple[int, int]]] = [[] for _ in texts]
            for segment, _, _, x in _asked_segments(touched, marked, length):
                marks = x["marks"] or [0, segment.last - segment.first]
                for first, last in zip(marks[::2], marks[1::2], strict=True):
                    ranges[segment.text].append((segment.first + first, segment.first + last + length))
            spans, kept = [], []
            for text, one in zip(texts, ranges, strict=True):
                runs, at, parts = _merged(one), 0, []
                for start, end in runs:
                    parts.append(text[at:start])
                    at = end
                spans.append([{"start": start, "end": end} for start, end in runs])
                kept.append(b"".join([*parts, text[at:]]))
            sizes = pa.array([len(text) for text in texts], pa.int64())
            columns = [batch.column(0), sizes, pa.array(spans, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

    return cut


def without_repeats(docs: DataFrame, length: int = LENGTH, result: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """doc_id, n_bytes, spans (the removed runs, end exclusive), kept (the other bytes): one row per row of doc_id, text.

    ``result`` takes these columns to those that are stored and returned.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    numbered = docs.select(F.col("doc_id").cast("bigint"), text.alias("text")).withColumn("row", F.monotonically_increasing_id())
    texts, name = bucketed(numbered, "texts", "row")
    signed = texts.select("row", "text").filter(F.length("text") >= length).mapInArrow(_signed(length), _SIGNED)
    seen = stored(signed, "seen")
    different = seen.groupBy("h", "c").agg(F.sum("n").alias("n"), F.min("row").alias("row"), F.count(F.lit(1)).alias("texts"))
    different = stored(different, "different")
    grouped = stored(_grouped(different, different.count()), "grouped")
    discard(different)

    asked = grouped.filter(_to_index()).groupBy("row").agg(F.collect_list(F.struct("h", "c", "n", "size")).alias("asked"))
    fetched = texts.select("row", "text").join(asked, "row").select("row", "text", "asked").mapInArrow(_fetched(length), _PIECES)
    made = [seen, grouped, stored(fetched, "pieces")]
    single = _single_marks(made[-1], length, made).withColumn("texts", F.lit(1).cast("bigint"))
    whole = grouped.filter("n > 1").select("h", "c", "texts", F.lit(None).cast("array<int>").alias("marks"))
    verdicts = stored(whole.unionByName(single), "verdicts")
    made.append(verdicts)

    marks = joined_counted(seen.select("row", "h", "c"), verdicts, ["h", "c"], "texts", seen.count())
    marks = marks.groupBy("row").agg(F.collect_list(F.struct("h", "c", "marks")).alias("found"))
    cut = texts.join(marks, "row", "left").select("doc_id", "text", "found").mapInArrow(_cut(length), _CUT)
    cut = stored(result(cut) if result else cut, "cut")
    for frame in made:
        discard(frame)
    drop_table(texts, name)
    return cut


def digests(cut: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of what ``without_repeats`` found."""
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
