"""Benchmark decontamination by templates.

Words become template words: numbers, units and names (capitalised words inside a sentence) are replaced by a placeholder
of their kind, everything else is lowered. Windows of five template words of the benchmark and of the documents are
joined by hash; a question asked again with other numbers or names has the same template. A match with changed slots counts
only if they are consistent: along one alignment, equal slot values of the item must stand for equal values in the document.
Where each value stands for one value at more than half of its places, only the windows that contradict it are dropped;
where one has no such majority, all windows with changed slots are. Windows with no slot or unchanged slots always count.

Windows of the benchmark with more than two placeholders say too little as templates. They are literal windows: hashed
with their values, and found where a document has the same lowered words, whatever their kinds. An item of one to four
words is one literal window of all its words, found wherever a document has these words in a row. Scripts without blanks
between words are split by character.

A document leaks an item if half of the item's windows (five at least, or all of fewer) are found in it, or so many of its
template windows alone, or nine windows along one alignment, which is a passage of thirteen words.

The documents' windows are first looked up in a bitmap of the benchmark's hashes. Its size follows the number of the benchmark's
windows up to 16 MB (eight million windows at a sixteenth of the bits set, more windows at denser bits); what passes is joined exactly. Pairs of document and item start from each item's rarest windows: enough
of them that a leak cannot miss all (so a phrase that all items share makes no pairs).

Defined results: a text without words (null, empty, signs only) has no windows and neither leaks nor is leaked; repeated
rows get equal results; a null doc_id is reported as not contaminated; an empty benchmark leaves all documents clean;
coverage is the larger share, of all windows or of the template windows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import claim, kept, stored, windows
from clickmill.llm.tokens import portions, text_bytes

WIDTH = 5
LEAST_WORDS = 3  # literal words in a template window
LEAST_SHARE = 0.5
LEAST_WINDOWS = 5
ALIGNED_WINDOWS = 9
# Bits of the bitmap: so many for each window of the benchmark, as a power of two between these two numbers (512 KB, 16 MB).
BITS_A_WINDOW = 16
BITMAP_BITS, MOST_BITMAP_BITS = 1 << 22, 1 << 27
# White-space parts that a worker knows; beyond this number it forgets all but the first CORE_WORDS, which hold most of the frequent ones.
CACHE_WORDS = 300_000
CORE_WORDS = 150_000

UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound"
    " pounds oz ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour"
    " hours day days week weeks month months year years percent dollar dollars cent cents euro euros degree degrees"
    " mph kmh kb mb gb tb hz khz mhz ghz w kw mw v kv j kj cal kcal c f k".split()
)
# Letters of scripts without blanks between words: Thai and Lao, Burmese, Khmer, kana, Han.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
    "\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff"
)
_LETTER = rf"[^\W\d_{_UNSPACED}]"
# A number, or a word.
_TOKEN = re.compile(rf"(\d(?:[\d.,/:]*\d)?)|({_LETTER}+(?:['’]{_LETTER}+)*|(?=[{_UNSPACED}])[^\W\d_])")
_LITERAL, _NUMBER, _UNIT, _NAME = range(4)
_CLOSING, _ENDS = b"\"')]", (b".", b"!", b"?")


class TemplateWords:
    """Template words by number, and for each white-space part seen the numbers of its template words."""

    def __init__(self) -> None:
        self.clear()

    def __len__(self) -> int:
        return len(self.parts)

    def clear(self) -> None:
        self.parts: dict[bytes, bytes] = {}
        # Per template word: the hash of the lowered word, and whether it is a number, a unit, name-like, and ends a sentence.
        self.value = np.zeros(0, np.uint64)
        self.flags = np.zeros((0, 4), bool)

    def forget(self) -> None:
        """Keep the first parts only; template words are numbered in the order of the parts."""
        self.parts = dict(islice(self.parts.items(), CORE_WORDS))
        words = sum(map(len, self.parts.values())) // 4
        if words > CACHE_WORDS:
            self.clear()
        else:
            self.value, self.flags = self.value[:words].copy(), self.flags[:words].copy()

    def learn(self, parts: set[bytes]) -> None:
        """Take in new parts, all at once."""
        # A part may hold many template words where a script has no blanks.
        if max(len(self.parts), len(self.value) // 2) > CACHE_WORDS:
            self.forget()
        values, flags, at = [], [], len(self.value)
        for part in parts.difference(self.parts):
            core = part.rstrip(b".,;:!?")
            # Most parts are one word of ASCII letters.
            tokens = [("", core.decode())] if core.isalpha() else _TOKEN.findall(part.decode())
            first = at
            for number, word in tokens:
                lowered = (number or word).lower()
                values.append(xxhash.xxh3_64_intdigest(lowered))
                named = len(word) > 1 and word[0].isupper() and word[1:].islower()
                at += 1
                flags.append((bool(number), lowered in UNITS, named, at == first + len(tokens) and part.rstrip(_CLOSING).endswith(_ENDS)))
            self.parts[part] = np.arange(first, at, dtype=np.int32).tobytes() if at > first + 1 else first.to_bytes(4, "little") * (at - first)
        if values:
            self.value = np.append(self.value, np.array(values, np.uint64))
            self.flags = np.append(self.flags, np.array(flags, bool), axis=0)

    def template(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per template word of learnt parts, text after text, its code, its kind and its value; and where texts begin."""
        numbers = [b"".join(map(self.parts.__getitem__, words)) for words in texts]
        begins = np.cumsum([0, *(len(n) // 4 for n in numbers)])
        at = np.frombuffer(b"".join(numbers), np.int32)
        value, flags = self.value[at], self.flags[at]
        inside, after_number = np.zeros(len(at), bool), np.zeros(len(at), bool)
        inside[1:], after_number[1:] = ~flags[:-1, 3], flags[:-1, 0]
        first = begins[begins < len(at)]
        inside[first] = after_number[first] = False
        kind = np.where(flags[:, 2] & inside, _NAME, _LITERAL)
        kind = np.where(flags[:, 0], _NUMBER, np.where(flags[:, 1] & after_number, _UNIT, kind))
        return np.where(kind == _LITERAL, value, kind.astype(np.uint64)), kind, value, begins


_WORDS = kept(TemplateWords())


def _template_windows(bitmap: bytes | None, widths: Iterable[int] = ()):
    """id, place, hash, literal, width, at, slots: of the benchmark, each window by its template or else literally.

    With a bitmap, of documents: each window by its template and literally, and the runs of ``widths`` words, each once a
    text; only those found in the bitmap.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(_WORDS)
        known = None if bitmap is None else np.frombuffer(bitmap, np.uint8)

        def passes(hashes: np.ndarray) -> np.ndarray:
            if known is None:
                return np.ones(len(hashes), bool)
            bit = (hashes % np.uint64(8 * len(known))).astype(np.int64)
            return (known[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)

        for batch in portions(batches):
            texts = [text.split() for text in text_bytes(batch.column(1))]
            _WORDS.learn(set().union(*texts))
            codes, kind, value, begins = _WORDS.template(texts)
            sizes = np.diff(begins)
            row = np.repeat(np.arange(len(sizes)), sizes)
            filled = kind != _LITERAL
            before = np.append(0, np.cumsum(filled))
            n_filled = before[WIDTH:] - before[:-WIDTH]
            whole = row[WIDTH - 1 :] == row[: len(n_filled)]
            dense = n_filled > WIDTH - LEAST_WORDS
            hashes, exact = windows(codes, WIDTH), windows(value, WIDTH)
            places = np.flatnonzero(whole & ~dense & passes(hashes))
            literal = np.flatnonzero(whole & (dense if known is None else n_filled > 0) & passes(exact))
            found = [(places, hashes[places], WIDTH), (literal, exact[literal], WIDTH)]
            for width in range(1, WIDTH) if known is None else widths:
                runs = windows(value, width)
                within = row[width - 1 :] == row[: len(runs)]
                # A short item is one window; in a text its first place is enough.
                hits = np.flatnonzero(within & ((sizes == width)[row[: len(runs)]] if known is None else passes(runs)))
                hits = hits[np.sort(np.unique(np.stack([row[hits].astype(np.uint64), runs[hits]]), axis=1, return_index=True)[1])]
                found.append((hits, runs[hits], width))
            slot = filled[places[:, None] + np.arange(WIDTH)]
            spots = (places[:, None] + np.arange(WIDTH))[slot]
            ends = np.append(np.cumsum(np.append(0, slot.sum(axis=1))), np.full(sum(len(f[0]) for f in found[1:]), len(spots)))
            offsets = pa.array(ends, pa.int32())
            all_places = np.concatenate([f[0] for f in found])
            columns = [
                batch.column(0).take(pa.array(row[all_places])),
                pa.array(all_places - begins[row[all_places]]),
                pa.array(np.concatenate([f[1] for f in found]).view(np.int64)),
                pa.array(np.arange(len(all_places)) >= len(places)),
                pa.array(np.repeat([f[2] for f in found], [len(f[0]) for f in found]), pa.int32()),
                pa.ListArray.from_arrays(offsets, pa.array(spots - begins[row[spots]])),
                pa.ListArray.from_arrays(offsets, pa.array(value[spots].view(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "place", "hash", "literal", "width", "at", "slots"])

    return cut


def _windows_of(rows: DataFrame, key: str, bitmap: bytes | None = None, widths: Iterable[int] = ()) -> DataFrame:
    texts = rows.select(F.col(key).cast("bigint"), F.col("text").cast("string")).filter(F.col(key).isNotNull())
    columns = "id bigint, place bigint, hash bigint, literal boolean, width int, at array<bigint>, slots array<bigint>"
    return texts.mapInArrow(_template_windows(bitmap, widths), columns)


def bitmap_bits(n_windows: int) -> int:
    """The size of the bitmap for a benchmark of so many windows: a power of two, so the remainder needs no unsigned numbers."""
    wanted = 1 << (max(BITS_A_WINDOW * n_windows, 1) - 1).bit_length()
    return min(max(wanted, BITMAP_BITS), MOST_BITMAP_BITS)


def _bitmap_of(hashes: DataFrame) -> bytes:
    """A bit for each remainder of a hash, set if there is one; made by the aggregate for bitmaps and fetched in pieces of 4 KB."""
    n_bits = bitmap_bits(hashes.count())
    # The remainder of the hash as an unsigned number, as the workers take it.
    bit = F.pmod("hash", F.lit(n_bits)) + 1
    bits = hashes.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
    rows = bits.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect()
    pieces = {row["bucket"]: bytes(row["bits"]) for row in rows}
    size = 32768
    return b"".join(pieces.get(bucket, bytes(size // 8)) for bucket in range(1, n_bits // size + 1))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, coverage, aligned, reparameterised: the items that each document leaks."""
    cut = _windows_of(benchmark, "item_id").select(
        F.col("id").alias("item_id"), F.col("place").alias("item_place"), "hash", "literal", "width", "at", F.col("slots").alias("item_slots")
    )
    item = stored(cut.distinct(), "item-windows")
    by_item = Window.partitionBy("item_id")
    template = F.when(~F.col("literal"), 1)
    counted = item.withColumn("total", F.count(F.lit(1)).over(by_item)).withColumn("total_template", F.count(template).over(by_item))

    def needed(total: Column) -> Column:
        return F.greatest(F.ceil(total * LEAST_SHARE), F.least(total, F.lit(LEAST_WINDOWS)))

    widths = [row["width"] for row in item.filter(F.col("width") < WIDTH).select("width").distinct().collect()]
    hits = stored(
        _windows_of(docs, "doc_id", _bitmap_of(item), widths).select(F.col("id").alias("doc_id"), "place", "hash", "slots").distinct(), "hits"
    )

    # Of ``total`` windows a leak has ``least``; among the total - least + 1 rarest ones it has at least one. So with the
    # template windows alone.
    shared = counted.withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("hash")))
    rarest = ["shared", "hash", "item_place"]
    rarity = F.row_number().over(by_item.orderBy(*rarest))
    rarity_template = F.row_number().over(by_item.orderBy("literal", *rarest))

    def rare_enough(rank: str, total: str) -> Column:
        return F.col(rank) <= F.col(total) - F.least(needed(F.col(total)), F.lit(ALIGNED_WINDOWS)) + 1

    ranked = shared.withColumn("rarity", rarity).withColumn("rarity_template", rarity_template)
    rare = ranked.filter(rare_enough("rarity", "total") | (~F.col("literal") & rare_enough("rarity_template", "total_template")))
    pairs = hits.select("doc_id", "hash").join(rare.select("item_id", "hash"), "hash").select("doc_id", "item_id").distinct()

    found = pairs.join(counted, "item_id").join(hits, ["doc_id", "hash"])
    placed = found.withColumn("shift", F.col("place") - F.col("item_place"))
    slot_pairs = F.arrays_zip(F.col("at"), F.col("item_slots").alias("item"), F.col("slots").alias("doc"))
    by_shift = placed.groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set(F.struct("item_place", "literal", slot_pairs.alias("pairs"))).alias("windows"),
        F.first("total").alias("total"),
        F.first("total_template").alias("total_template"),
    )

    def values(pair: Column) -> Column:
        return F.struct(pair["item"].alias("item"), pair["doc"].alias("doc"))

    spots = F.array_distinct(F.flatten(F.transform("windows", lambda window: window["pairs"])))
    paired = by_shift.withColumn("spots", spots).withColumn("pairs", F.array_distinct(F.transform("spots", values)))
    n_values = F.size(F.array_distinct(F.transform("pairs", lambda pair: pair["item"])))

    def unchanged(window: Column) -> Column:
        return F.forall(window["pairs"], lambda spot: spot["item"] == spot["doc"])

    def in_majority(pair: Column) -> Column:
        places = F.filter("spots", lambda spot: spot["item"] == pair["item"])
        return 2 * F.size(F.filter(places, lambda spot: spot["doc"] == pair["doc"])) > F.size(places)

    def follows(window: Column) -> Column:
        return unchanged(window) | (F.col("decided") & F.forall(window["pairs"], lambda spot: F.array_contains("binding", values(spot))))

    # Only a torn alignment, where one value of the item stands for several, is looked at spot by spot.
    torn = F.size("pairs") != n_values
    bound = paired.withColumn("torn", torn).withColumn("binding", F.when(F.col("torn"), F.filter("pairs", in_majority)))
    decided = bound.withColumn("decided", F.size("binding") == n_values)
    kept = decided.withColumn("windows", F.when(F.col("torn"), F.filter("windows", follows)).otherwise(F.col("windows")))
    changed = F.exists("windows", lambda window: ~unchanged(window))
    places = F.array_distinct(F.transform("windows", lambda window: F.struct(window["item_place"].alias("item_place"), window["literal"].alias("literal"))))
    consistent = kept.withColumn("changed", changed).withColumn("places", places)
    # An item's place counts once, however often the document repeats it.
    of_pair = ["doc_id", "item_id", "total", "total_template"]
    places = consistent.select(*of_pair, "changed", F.size("places").alias("n"), F.explode("places").alias("place"))
    by_place = places.groupBy(*of_pair, "place").agg(F.max("n").alias("n"), F.min("changed").alias("changed"))
    pairs = by_place.groupBy(*of_pair).agg(
        F.count(F.lit(1)).alias("covered"), F.count(F.when(~F.col("place.literal"), 1)).alias("covered_template"),
        F.max("n").alias("aligned"), F.max("changed").alias("reparameterised"),
    )
    enough = F.col("covered") >= needed(F.col("total"))
    enough_template = (F.col("total_template") > 0) & (F.col("covered_template") >= needed(F.col("total_template")))
    leaked = pairs.filter(enough | enough_template | (F.col("aligned") >= ALIGNED_WINDOWS))
    share_template = F.when(F.col("total_template") > 0, F.col("covered_template") / F.col("total_template"))
    coverage = F.greatest(F.col("covered") / F.col("total"), share_template)
    return leaked.select("doc_id", "item_id", coverage.alias("coverage"), "aligned", "reparameterised")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items, coverage, reparameterised: one row per row of doc_id, text."""
    by_doc = leaks(docs, benchmark).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
        F.max("coverage").alias("coverage"),
        F.max("reparameterised").alias("reparameterised"),
    )
    ids = docs.select(F.col("doc_id").cast("bigint"))
    none = F.array().cast("array<bigint>")
    return ids.join(by_doc, "doc_id", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"),
    )
