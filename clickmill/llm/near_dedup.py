"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped candidate edges.

A document is the set of its distinct five-word shingles. One hash per shingle serves all bins of the signature (the
smallest hash of a bin's range), empty bins borrow from full ones by optimal densification, and neighbouring bins form
bands. Documents with equal sets are one class and enter the buckets once. In each bucket only the edges from a few
centres are candidates. A document's weight is the number of members that its buckets hold, so in a group of edited copies
the least edited one weighs most; the heaviest member of a bucket is its centre, and each document is first compared with
the heaviest of its centres. Where a bucket's members still lie in several components, each gets a limit: the most shingles
that a document of another component can have to be linked with it, from the number of its shingles that occur there at all.
A member with no partner within its limit is settled. The two heaviest of the others are compared with the members of other
components within the limits of both, and in further rounds members outside of the bucket's largest component, until the
members that were no centre lie in one component. So no link between two members of a bucket is lost. In a group of edited
copies those far from the least edited one share with others only what they share with it, so just clearly shorter copies
are within their limits. Of the pairs within them, those whose sets surely differ in too many shingles are no candidates: the
parities of the number of shingles in each of some hundred hash ranges differ in at most as many places as the sets in shingles,
a lower bound that loses no link. So the pairs that are confirmed on full sets follow the possible links, not the square of the
group; only the parities, a few words per member, are compared within a bucket's open members.

With 32 bands of 4 bins, two documents at the threshold of 0.75 share a bucket with probability 1 - 5e-6, more similar
ones more surely.

Defined results: a document without words (null, empty, blanks only) has an empty set and is linked with nothing;
fewer than five words are one shingle; rows with the same doc_id are the same document, linked by all of their texts
(n_shingles is that of the row); a null doc_id is linked with nothing and its component_id is null; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import WordHash, claim, discard, hashes, kept, mixed, small_side, stored, windows
from clickmill.llm.tokens import portions, text_bytes

SHINGLE_WORDS = 5
BANDS = 32
ROWS = 4
# A link: SHARE_OF * (size of the intersection) >= SHARE * (size of the union).
SHARE, SHARE_OF = 75, 100
PROBES = 256
# Centres that a bucket may have in its second round; each further round allows as many times more.
CENTRES = 8
# Places of a parity sketch, a multiple of 64. Sets that differ in more shingles than this are seldom told apart by it.
PARITIES = 1024
# The limit of a member that has none.
ANY_SIZE = (1 << 63) - 1

_WORDS = kept(WordHash())


def shingle_sets(texts: list[bytes], width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; words are separated by ASCII white space, A-Z is lowered."""
    words = [text.lower().split() for text in texts]
    flat = hashes([word for one in words for word in one], _WORDS)
    whole = windows(flat, width)
    at = 0
    for one in words:
        n = len(one)
        if n >= width:
            yield np.unique(whole[at : at + n - width + 1])
        else:
            yield windows(flat[at : at + n], n) if n else flat[:0]
        at += n


def _probes(bins: int) -> np.ndarray:
    """For each bin the bins that it asks when it is empty: independent draws, the same for all documents."""
    draws = mixed(np.arange(bins * PROBES, dtype=np.uint64) + np.uint64(0x51ED270B))
    return (draws % np.uint64(bins)).astype(np.int64).reshape(bins, PROBES)


def signature(shingles: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin of a non-empty sorted set; empty bins take that of the first full bin asked."""
    bin_of = ((shingles >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.searchsorted(bin_of, np.arange(bins, dtype=np.uint64))
    full = first < len(shingles)
    full[full] = bin_of[first[full]] == np.flatnonzero(full)
    source = np.arange(bins)
    source[~full] = -1
    for step in range(probes.shape[1]):
        empty = np.flatnonzero(source < 0)
        if not len(empty):
            break
        asked = probes[empty, step]
        source[empty] = np.where(full[asked], asked, -1)
    # All draws failed (possible only for very few shingles): the full bin that follows, around the end.
    at = np.flatnonzero(full)
    empty = np.flatnonzero(source < 0)
    source[empty] = at[np.searchsorted(at, empty) % len(at)]
    return shingles[first[source]]


def _band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    total = np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for column in values.reshape(bands, rows).T:
        total = mixed(total ^ column) * np.uint64(0x9E3779B97F4A7C15)
    return total


def _signed(bands: int, rows: int, width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(_WORDS)
        probes = _probes(bands * rows)
        for batch in portions(batches):
            sizes, digests, keys = [], [], []
            for shingles in shingle_sets(text_bytes(batch.column(1)), width):
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                found = _band_keys(signature(shingles, bands * rows, probes), bands, rows) if len(shingles) else shingles
                keys.append(found.view(np.int64))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "keys"])

    return sign


def parity_sketch(shingles: np.ndarray, places: int = PARITIES) -> np.ndarray:
    """One bit per place, 64 to a word: whether an odd number of shingles has that place.

    A shingle in one of two sets but not in the other changes one bit, so two sketches differ in at most as many bits as the
    sets in shingles.
    """
    counts = np.bincount((shingles % np.uint64(places)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def _full_sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(_WORDS)
        for batch in portions(batches):
            found = list(shingle_sets(text_bytes(batch.column(1)), width))
            columns = [
                batch.column(0),
                pa.array([s.tobytes() for s in found], pa.binary()),
                pa.array([parity_sketch(s) for s in found], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "set", "parities"])

    return sets


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    claim()
    for batch in batches:
        kept = []
        for row, (left, right) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
            shared = len(np.intersect1d(a, b, assume_unique=True))
            if SHARE_OF * shared >= SHARE * (len(a) + len(b) - shared):
                kept.append(row)
        yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("bigint"), text.alias("text"))


def _mark(edges: DataFrame) -> tuple:
    """The number of edges and a sum of their hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """id, root: for every end of the edges (a, b) the smallest id that it is connected with.

    Large-star and small-star steps in turn; both are joins with an aggregate per node, so a node with many edges is
    spread like any large join key. Every step is stored.
    """
    forward = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    current = stored(edges.filter(F.col("a") != F.col("b")).select(*forward).distinct(), "edges")
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(current)
        current = following
        found = _mark(current)
        if found == mark:
            break
        mark = found
    roots = current.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("root"))
    return current.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)


def _sets_of(buckets: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """id, set, parities for all members of buckets, stored."""
    ids = stored(buckets.select(F.col("id").alias("doc_id")).distinct(), "members")
    found = texts.join(small_side(ids, ids.count(), 16), "doc_id", "left_semi").mapInArrow(
        _full_sets(width), "id bigint, set binary, parities array<bigint>"
    )
    return stored(found, "sets")


def _with_parities(active: DataFrame, sets: DataFrame) -> DataFrame:
    """Add the sketch of each id; null for an id with several different texts, which has no single one."""
    sketch = F.struct(F.length("set").alias("bytes"), "parities")
    spans = sets.groupBy("id").agg(F.min(sketch).alias("least"), F.max(sketch).alias("most"))
    single = spans.filter("least = most").select("id", F.col("least")["parities"].alias("parities"))
    return active.join(single, "id", "left")


def _may_be_near(left: str, right: str, left_size: str, right_size: str) -> Column:
    """False only if two sets of these sizes differ in too many shingles for a link, by their sketches; true if one has none.

    Of sets with s shingles together, d of them in one set only, the intersection has (s - d) / 2 and the union (s + d) / 2.
    """
    bits = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(PARITIES // 64)]
    differing = reduce(Column.__add__, bits)
    near = (SHARE_OF + SHARE) * differing <= (SHARE_OF - SHARE) * (F.col(left_size) + F.col(right_size))
    return F.coalesce(near, F.lit(True))


def _similar_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The stored pairs (a, b) that are links, confirmed on the full sets of both."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = sets.join(small_side(ends, 2 * pairs.count(), 16), "id", "left_semi")
    with_a = pairs.join(needed.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    both = with_a.join(needed.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    return stored(both.select("a", "b", "set_a", "set_b").mapInArrow(_linked, "a bigint, b bigint").distinct(), "links")


def _roots_of(ids: DataFrame, roots: DataFrame, name: str, root: str) -> DataFrame:
    """Add ``root`` for the id column ``name``; an id without links is its own root."""
    found = roots.select(F.col("id").alias(name), F.col("root").alias(root))
    return ids.join(found, name, "left").withColumn(root, F.coalesce(root, name))


def _with_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The stored roots after further links (a, b): only the links between roots are followed, not those behind the roots again."""
    ends = _roots_of(_roots_of(links.select("a", "b"), roots, "a", "root_a"), roots, "b", "root_b")
    moved = stored(components(ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "moved")
    side = small_side(moved, moved.count(), 16)
    old = roots.select("id", F.col("root").alias("old"))
    kept = old.join(side.toDF("old", "root"), "old", "left").select("id", F.coalesce("root", "old").alias("root"))
    # Ids that had no link so far were their own roots.
    found = stored(kept.unionByName(moved.join(roots, "id", "left_anti")), "roots")
    discard(moved)
    return found


def _open_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """key, id, weight, n, root of the buckets whose members lie in several components."""
    return _of_several_roots(_roots_of(members.select("key", "id", "weight", "n"), roots, "id", "root"))


def _of_several_roots(rooted: DataFrame) -> DataFrame:
    """The members of the buckets that hold several roots."""
    return rooted.join(_open_keys(rooted), "key", "left_semi")


def _open_keys(rooted: DataFrame) -> DataFrame:
    """The keys of the buckets that hold several roots."""
    spans = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    return spans.filter("least < most").select("key")


def _shares(active: DataFrame) -> DataFrame:
    """key, root, share: how many members of a bucket a root has."""
    return active.groupBy("key", "root").agg(F.count(F.lit(1)).alias("share"))


def _outside_largest(active: DataFrame) -> DataFrame:
    """The members that do not belong to the root with the most members of their bucket."""
    largest = _shares(active).groupBy("key").agg(F.max(F.struct("share", "root")).alias("largest"))
    return active.join(largest, "key").filter(F.col("root") != F.col("largest")["root"]).drop("largest")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first two columns, and every shingle of the set in the third."""
    claim()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sizes = np.array([len(x) // 8 for x in part.column(2).to_pylist()], np.int64)
            shingles = np.frombuffer(b"".join(part.column(2).to_pylist()), np.int64)
            columns = [pa.array(np.repeat(part.column(i).to_numpy(), sizes)) for i in (0, 1)] + [pa.array(shingles)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "root", "shingle"])


def _limits(active: DataFrame, sets: DataFrame) -> DataFrame:
    """id, limit: the most shingles that a document of another component can have to be linked with the id.

    A text of n shingles, of which m occur in active documents of other components, shares at most m with any of them. A link of
    SHARE in SHARE_OF then needs (SHARE + SHARE_OF) * m >= SHARE * (n + the other's size). So the limit follows from counting
    alone. A copy that is not linked with the least edited one of its group mostly shares with the others what it shares with
    that one, so only shorter copies can be linked with it. Members of the largest components have no limit, as a link needs
    two components and the other one has one. An id takes the highest limit of its texts.
    """
    ids = stored(active.select("id", "root").distinct(), "rooted")
    rooted = ids.join(sets, "id").select("id", "root", "set")
    shingles = rooted.mapInArrow(_exploded, "id bigint, root bigint, shingle bigint")
    spread = shingles.groupBy("shingle").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
    outside = _outside_largest(active).select("id").distinct()
    text = F.xxhash64("set").alias("text")
    own = stored(rooted.join(outside, "id", "left_semi").filter(F.length("set") > 0).select("id", text, "set"), "minor")
    minor = own.mapInArrow(_exploded, "id bigint, text bigint, shingle bigint")
    elsewhere = minor.join(spread.select("shingle"), "shingle").groupBy("id", "text").agg(F.count(F.lit(1)).alias("m"))
    # Copies of a text count as often in its size as in m.
    sizes = own.groupBy("id", "text").agg(F.sum((F.length("set") / 8).cast("bigint")).alias("size"), F.count(F.lit(1)).alias("copies"))
    counted = sizes.join(elsewhere, ["id", "text"], "left").withColumn("m", F.coalesce("m", F.lit(0)))
    limit = F.expr(f"(({SHARE} + {SHARE_OF}) * m - {SHARE} * size) div ({SHARE} * copies)")
    found = stored(counted.groupBy("id").agg(F.max(limit).alias("limit")), "limits")
    for frame in (ids, own):
        discard(frame)
    return found


def _limited(active: DataFrame, limits: DataFrame) -> DataFrame:
    """The active members without those that can be linked with no member of another component of their bucket, with ``limit``.

    A member whose limit is too small for its own size has no partner at all, and goes first with the buckets that it kept open,
    as only buckets of several roots have two smallest. Of the rest the smallest member of each component decides, and the highest
    limit of each, as a member has no partner either if it is larger than all others allow; the two smallest and the two highest of
    different components suffice for all. A bucket that is left with one component all the same closes when the next round asks.
    """
    alone = F.coalesce(SHARE * F.col("n") > SHARE_OF * F.col("limit"), F.lit(False))
    known = active.join(limits, "id", "left").filter(~alone)
    reach = F.coalesce("limit", F.lit(ANY_SIZE))
    spans = known.groupBy("key", "root").agg(F.min("n").alias("least"), F.max(reach).alias("reach"))
    ends = F.min(F.struct("least", "root")).alias("first"), F.max(F.struct("reach", "root")).alias("widest")
    others = spans.join(spans.groupBy("key").agg(*ends), "key")
    pair = others.groupBy("key", "first", "widest").agg(
        F.min(F.when(F.col("root") != F.col("first")["root"], F.col("least"))).alias("second"),
        F.max(F.when(F.col("root") != F.col("widest")["root"], F.col("reach"))).alias("next"),
    )
    smallest = F.when(F.col("root") == F.col("first")["root"], F.col("second")).otherwise(F.col("first")["least"])
    highest = F.when(F.col("root") == F.col("widest")["root"], F.col("next")).otherwise(F.col("widest")["reach"])
    able = (F.col("limit").isNull() | (smallest <= F.col("limit"))) & (F.col("n") <= highest)
    return known.join(pair.filter("second is not null"), "key").filter(able).drop("first", "widest", "second", "next")


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of doc_id, text."""
    texts = _texts(docs)
    columns = "doc_id bigint, n_shingles bigint, digest binary, keys array<bigint>"
    signed = stored(texts.mapInArrow(_signed(bands, rows, width), columns), "signatures")
    members = signed.filter("doc_id is not null and digest is not null")
    classes = stored(members.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")

    # One row of each class goes to the buckets; a bucket with one class is no bucket.
    rep_rows = members.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi")
    rep_rows = rep_rows.dropDuplicates(["digest", "doc_id"])
    banded = rep_rows.select(F.col("doc_id").alias("id"), F.explode("keys").alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"), F.max("id").alias("most"))
    sized = stored(banded.join(sizes.filter("least < most").select("key", "size"), "key"), "sized")
    # The least number of shingles of an id's texts.
    least = members.groupBy(F.col("doc_id").alias("id")).agg(F.min("n_shingles").alias("n"))
    weights = sized.groupBy("id").agg(F.sum("size").alias("weight")).join(least, "id")
    buckets = stored(sized.join(weights, "id").select("key", "id", "weight", "n"), "buckets")
    discard(sized)

    # Several texts under one doc_id are one document.
    same = members.join(classes, "digest").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    links = stored(
        members.join(classes, "digest").join(same.filter("a < b").select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")),
        "links",
    )

    sets = _sets_of(buckets, texts, width)

    # The heaviest centre of each document over all of its buckets; of equal weights the smaller id.
    rank = F.struct("weight", (-F.col("id")).alias("order"))
    centres = buckets.groupBy("key").agg(F.max(rank).alias("centre"))
    stars = buckets.join(centres, "key").groupBy("id").agg(F.max("centre").alias("centre"))
    centre = -F.col("centre")["order"]
    pairs = stars.filter(centre != F.col("id")).select(F.least(centre, "id").alias("a"), F.greatest(centre, "id").alias("b"))
    asked = stored(pairs.distinct(), "pairs")
    roots = stored(components(links.unionByName(_similar_pairs(asked, sets))), "roots")

    # The two heaviest members of the buckets that are still open, then other members, with those of other components.
    members, allowed = buckets, 0
    while True:
        active = stored(_open_members(members, roots), "active")
        if not active.isEmpty():
            limits = _limits(active, sets)
            limited = stored(_with_parities(_limited(active, limits), sets), "active")
            discard(active)
            discard(limits)
            active = limited
        if _open_keys(active).isEmpty():
            break
        if allowed:
            # Members outside of the largest component; those of the smallest components before others.
            able = _outside_largest(active).join(_shares(active), ["key", "root"])
            order, number = [F.col("share"), F.col("id")], allowed
        else:
            able, order, number = active, [F.desc("weight"), F.col("id")], 2
        place = F.row_number().over(Window.partitionBy("key").orderBy(*order))
        chosen = able.withColumn("place", place).filter(F.col("place") <= number)
        chosen = stored(chosen.select("key", "id", "root", "n", "limit", "parities"), "centres")
        centre = chosen.toDF("key", "centre", "centre_root", "centre_n", "centre_limit", "centre_parities")
        # Of other components, of a size that a link allows by the limits of both, and not surely too different.
        possible = (
            (F.col("centre_root") != F.col("root"))
            & (F.col("centre_n") <= F.coalesce("limit", "centre_n"))
            & (F.col("n") <= F.coalesce("centre_limit", "n"))
            & _may_be_near("parities", "centre_parities", "n", "centre_n")
        )
        crossed = active.join(centre, "key").filter(possible)
        fresh = crossed.select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")).distinct()
        pairs = stored(fresh.join(asked, ["a", "b"], "left_anti"), "pairs")
        before, asked = asked, stored(asked.unionByName(pairs), "asked")
        if not pairs.isEmpty() and not (found := _similar_pairs(pairs, sets)).isEmpty():
            roots = _with_links(roots, found)
        # A member that was a centre has been compared with all others of its bucket that it can be linked with.
        rest = active.select("key", "id", "weight", "n").join(chosen.select("key", "id"), ["key", "id"], "left_anti")
        if members is not buckets:
            discard(members)
        members = stored(rest, "members")
        for frame in (active, chosen, pairs, before):
            discard(frame)
        allowed = CENTRES * max(allowed, 1)
    discard(sets)
    class_roots = _roots_of(classes, roots, "rep", "root").select("digest", "root")
    # A doc_id with an empty text beside others keeps the component of the others.
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id")
    whole = signed.join(class_roots, "digest", "left").select("doc_id", "n_shingles", component)
    return whole.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
