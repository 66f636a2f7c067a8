"""Near-duplicate classes against all pairs."""

import random

import numpy as np

from clickmill.llm.common import mixed, table
from clickmill.llm import near_dedup
from clickmill.llm.near_dedup import _limited, _of_several_roots, components, near_duplicates, parity_sketch


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    """doc_id -> component over all links; rows with one doc_id are one node."""
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows]
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if s and t and 100 * both >= 75 * (len(s) + len(t) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d in parent}


def check(df, rows):
    roots = brute([r for r in rows if r[0] is not None])
    wanted = sorted([(d, len(shingles(t)), roots.get(d), d is None or roots[d] == d) for d, t in rows], key=str)
    assert sorted(map(tuple, df.collect()), key=str) == wanted


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_odd_rows(documents):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, "a b c d e f g h"), (2, "A B c d  e\tf g h"), (3, "a b c"), (4, "a b c"), (5, "a b"), (6, ""), (7, None), (8, " \n"), (9, ""),
        (2, "A B c d  e\tf g h"), (None, "a b c"), (10, long), (11, long + " x"), (12, "É b c d e"), (13, "é b c d e"), (14, "a\xa0b c d e"),
    ]
    check(near_duplicates(documents(*rows)), rows)


def test_one_document_with_several_texts_links_their_groups(documents):
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (5, "k l m n o p"), (9, "k l m n o p")]
    check(near_duplicates(documents(*rows)), rows)


def test_a_long_text_does_not_settle_the_short_text_of_its_document(documents):
    core, own = [f"c{i}" for i in range(700)], lambda name, n: [f"{name}x{i}" for i in range(n)]
    # A heavy group of texts that are alike but not linked; 1 and 2 share buckets with it by their long texts.
    rows = [(100 + g, " ".join(core + own(f"g{g}", 150))) for g in range(14)]
    rows += [(d, " ".join(core[:500] + own(f"d{d}", 350))) for d in (1, 2)]
    rows += [(1, " ".join([*own("s", 20), "one"])), (2, " ".join([*own("s", 20), "two"])), (2, " ".join([*own("s", 20), "two"]))]
    check(near_duplicates(documents(*rows)), rows)


def test_sketches_differ_in_no_more_places_than_the_sets():
    rng = np.random.default_rng(3)
    for shared, left, right in ((0, 0, 1), (90, 5, 5), (600, 100, 300), (50, 3_000, 2_000), (5_000, 0, 0)):
        values = np.unique(mixed(np.arange(shared + left + right, dtype=np.uint64) + np.uint64(rng.integers(1 << 40))))
        rng.shuffle(values)
        a, b = np.sort(values[: shared + left]), np.sort(np.concatenate([values[:shared], values[shared + left :]]))
        apart = int(np.bitwise_count(parity_sketch(a) ^ parity_sketch(b)).sum())
        assert apart <= left + right and (apart > 0) == (left + right > 0)
        if 0 < left + right <= 100:
            assert apart >= 0.8 * (left + right)


def test_nothing_and_clashing_columns(spark, documents):
    assert near_duplicates(documents()).count() == 0
    df = spark.createDataFrame([(1, "a b", 1, 2, 3), (2, "a b", 1, 2, 3)], "doc_id bigint, text string, id bigint, key bigint, digest bigint")
    check(near_duplicates(df), [(1, "a b"), (2, "a b")])


def test_families_whose_centre_is_not_similar_to_all(documents):
    rng, rows = random.Random(5), []
    for family in range(6):
        base = [f"f{family}x{i}" for i in range(60)]
        texts = [edited(base, rng.choice([0, 1, 1, 2, 3]), rng) for _ in range(25)] + [" ".join(base)]
        rows += [(1000 * rng.randrange(100) + family * 30 + i, t) for i, t in enumerate(texts)]
    check(near_duplicates(documents(*rows)), rows)


def test_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check(near_duplicates(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 101)], "a bigint, b bigint")
    found = {r["id"]: r["root"] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def _joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_open_members_are_found_by_one_join_on_the_bucket(spark):
    rooted = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (2, 1, 5), (2, 2, 5), (2, 3, 6), (3, 3, 6)], "key bigint, id bigint, root bigint")
    found = _of_several_roots(rooted)
    assert sorted(map(tuple, found.collect())) == [(2, 1, 5), (2, 2, 5), (2, 3, 6)]
    assert _joins(found) == 1


def test_a_bucket_closes_with_its_last_member_of_another_root(spark):
    active = spark.createDataFrame(
        # 3 can have no partner, so bucket 1 closes; in bucket 2 the smallest of each root are within the limits.
        [(1, 1, 9, 100, 1), (1, 2, 9, 100, 1), (1, 3, 9, 100, 3), (2, 1, 9, 100, 1), (2, 4, 9, 90, 4), (3, 4, 9, 90, 4), (3, 5, 9, 120, 5)],
        "key bigint, id bigint, weight bigint, n bigint, root bigint",
    )
    limits = spark.createDataFrame([(3, 50), (4, 110)], "id bigint, limit bigint")
    found = _limited(active, limits)
    assert sorted((r["key"], r["id"]) for r in found.collect()) == [(2, 1), (2, 4)]
    assert _joins(found) <= 11


def test_open_buckets_are_asked_for_once_a_round(spark, documents, monkeypatch):
    rng, base, asked = random.Random(8), [f"b{i}" for i in range(60)], []
    rows = [(i, edited(base, rng.choice([0, 1, 2, 3, 4]), rng)) for i in range(60)]
    real, limits = near_dedup._of_several_roots, near_dedup._limits
    monkeypatch.setattr(near_dedup, "_of_several_roots", lambda rooted: asked.append("join") or real(rooted))
    monkeypatch.setattr(near_dedup, "_limits", lambda active, sets: asked.append("round") or limits(active, sets))
    check(near_duplicates(documents(*rows)), rows)
    # The last question finds no open bucket.
    assert asked.count("round") >= 1 and asked.count("join") <= asked.count("round") + 1


def test_further_links_join_components_by_their_roots(spark, monkeypatch):
    rng = random.Random(4)
    old = [(rng.randrange(60), rng.randrange(60)) for _ in range(25)]
    new = [(rng.randrange(80), rng.randrange(80)) for _ in range(15)] + [(3, 3)]
    frame = lambda pairs: spark.createDataFrame(pairs, "a bigint, b bigint")
    wanted = {r["id"]: r["root"] for r in components(frame(old + new)).collect()}
    roots = components(frame(old))
    followed = []
    monkeypatch.setattr(near_dedup, "components", lambda edges: followed.append(edges.count()) or components(edges))
    found = [tuple(r) for r in near_dedup._with_links(roots, frame(new)).collect()]
    assert len(dict(found)) == len(found) and dict(found) == wanted
    assert followed == [len(new)]


def test_nothing_is_followed_without_links(spark):
    assert components(spark.createDataFrame([(4, 4)], "a bigint, b bigint")).count() == 0
