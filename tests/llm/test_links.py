"""Decontamination, vector search, quotations and the pipeline on small tables with known results."""

import math

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from clickmill.llm import decontamination, quotations, vector_search
from clickmill.llm.common import table
from clickmill.llm.queries import ORACLES, QUERIES
from tests.llm.test_near_dedup import brute

QUESTION = "Anna buys 12 apples for 3 euros each on Monday and gives 12 of them to Peter. How much money is left in the purse of Anna?"
OTHER = "Maria buys 40 apples for 7 euros each on Friday and gives 40 of them to Josef. How much money is left in the purse of Maria?"
MIXED = "Maria buys 40 apples for 7 euros each on Friday and gives 41 of them to Josef. How much money is left in the purse of Berta?"
CLEAN = "a wholly different text about rivers and mountains that nobody has asked anything about so far in this or another place"


def leaks_of(spark, documents, docs, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return {r["doc_id"]: r for r in decontamination.decontaminate(documents(*docs), bench).collect()}


def test_templates_catch_other_numbers_and_names(spark, documents):
    docs = [(1, f"{CLEAN} {QUESTION} {CLEAN}"), (2, f"{CLEAN}. {OTHER} {CLEAN}"), (3, CLEAN), (4, None), (5, ""), (6, "word " * 50_000), (7, QUESTION.lower() + " ")]
    found = leaks_of(spark, documents, docs, [(10, QUESTION), (11, None), (12, "too short"), (13, "")])
    assert {d for d, r in found.items() if r["contaminated"]} == {1, 2, 7}
    assert [found[1]["reparameterised"], found[2]["reparameterised"]] == [False, True]
    assert found[1]["items"] == [10] and found[3]["items"] == [] and len(found) == 7


def test_inconsistent_slots_are_no_leak(spark, documents):
    found = leaks_of(spark, documents, [(1, OTHER), (2, MIXED)], [(10, QUESTION)])
    assert found[1]["contaminated"] and not found[2]["contaminated"]


LONG = (
    "In the spring a farmer had 15 sheep on the hill behind the old mill and sold some of them to a trader who came over the"
    " river every year with a wide boat full of wool and salt and then the farmer counted what was left and found that again"
    " 15 were there because the neighbour had brought back those that were lost in the long winter before"
)


def test_one_edited_slot_does_not_hide_the_item(spark, documents):
    edited = LONG.replace("again 15", "again 16")
    several = "A man with 15 cows lost 3 in the woods, but 15 were still on the list, and all 15 had names. So he looked for 15 in the dark of the night."
    changed = several.replace("15", "22").replace("3", "4").replace("all 22", "all 23")
    found = leaks_of(spark, documents, [(1, edited), (2, changed), (3, MIXED)], [(10, LONG), (11, several), (12, QUESTION)])
    assert found[1]["items"] == [10] and not found[1]["reparameterised"] and 0.8 < found[1]["coverage"] < 1
    assert found[2]["items"] == [11] and found[2]["reparameterised"] and found[2]["coverage"] < 1
    assert not found[3]["contaminated"]


def test_part_of_a_long_item_and_shared_phrases(spark, documents):
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    long = " ".join(words)
    items = [(1, long)] + [(10 + i, f"what is the name of the place where item {chr(97 + i)}x was found") for i in range(8)]
    docs = [(1, "x y z " + " ".join(words[50:63])), (2, "x y z " + " ".join(words[50:60])), (3, items[3][1]), (3, items[3][1]), (None, long)]
    found = leaks_of(spark, documents, docs, items)
    assert found[1]["items"] == [1] and not found[2]["contaminated"] and 12 in found[3]["items"] and not found[None]["contaminated"]


def test_decontamination_of_nothing(spark, documents):
    assert leaks_of(spark, documents, [], [(1, QUESTION)]) == {}
    assert not leaks_of(spark, documents, [(1, QUESTION)], [])[1]["contaminated"]
    extra = spark.createDataFrame([(1, QUESTION, 3, 4, 5)], "doc_id bigint, text string, items bigint, place bigint, item_id bigint")
    bench = spark.createDataFrame([(1, QUESTION, 3)], "item_id bigint, text string, doc_id bigint")
    assert decontamination.decontaminate(extra, bench).first()["contaminated"]


def test_items_without_template_windows_are_found_verbatim(spark, documents):
    texts = [
        "What is 12 + 7 * 3 - 5?", "Pride And Prejudice Was Written By Jane Austen", "Wann beginnt Kaiser Wilhelm Krieg Gegen Frankreich",
        "中国的首都是哪一座城市请回答", "世界で最も高い山の名前は何ですか", "Who wrote Hamlet?", "Zanzibar",
    ]
    items = [(10 + i, text) for i, text in enumerate(texts)]
    docs = [(i, text) for i, text in enumerate(texts)] + [(20 + i, f"{CLEAN} {text} {CLEAN}") for i, text in enumerate(texts)]
    docs += [(40, "what is 12 + 7 * 3 - 6?"), (41, "Who wrote Othello, and who Hamlet?"), (42, CLEAN), (43, "中国的河流很长而且很美")]
    docs += [(44, "pride and prejudice was written by jane austen")]
    found = leaks_of(spark, documents, docs, items)
    assert [found[d]["items"] for d in range(7)] == [[10 + i] for i in range(7)]
    assert [found[20 + d]["items"] for d in range(7)] == [[10 + i] for i in range(7)]
    assert not any(found[d]["contaminated"] for d in (40, 41, 42, 43)) and found[44]["items"] == [11]


def test_dense_windows_do_not_hide_changed_numbers(spark, documents):
    sums = " ".join(f"{n} {n + 1} {n + 2} {n + 3}" for n in range(100, 180, 4))
    item = f"{sums} the farmer of the village sold 15 of his oldest and biggest sheep"
    copy = f"{sums.replace('1', '2')} the farmer of the village sold 93 of his oldest and biggest sheep"
    found = leaks_of(spark, documents, [(1, copy), (2, sums)], [(10, item)])
    assert found[1]["items"] == [10] and found[1]["reparameterised"] and found[2]["items"] == [10]


def test_benchmark_passages_of_the_table(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    items = [r["text"] for r in bench.collect()]
    whole = {r["doc_id"] for r in docs.collect() if any(item in (r["text"] or "") for item in items)}
    found = {r["doc_id"] for r in decontamination.decontaminate(docs, bench).collect() if r["contaminated"]}
    assert whole <= found and len(found) <= len(whole) + 1


def brute_top(rows, every=50, top=5):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {(i, tuple(v)) for i, v in vectors if i % every == 0}
    found = []
    for query, q in queries:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in vectors if i != query and len(v) == len(q))
        found += [(query, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:top])]
    return sorted(found)


def search(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return sorted(map(tuple, vector_search.top_products(df, **options).collect()))


def test_search_with_ties_and_odd_vectors(spark, documents):
    documents()
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 4]) for i in range(160)]
    rows += [(200, None), (250, [None, 1.0]), (300, [float("nan")] * 4), (350, [float("inf")] + [0.0] * 3), (None, [1.0] * 4), (400, [0.0] * 4), (450, [1.0, 2.0]), (7, [1.0] * 4)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert search(spark, rows) == brute_top(rows)


def test_search_with_a_crowded_ring(spark, documents, monkeypatch):
    documents()
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(4)
    rows = [(i, [0.5, 0.25, -0.5]) for i in range(100)] + [(i, [float(x) for x in rng.normal(size=3).astype(np.float32)]) for i in range(100, 300)]
    assert search(spark, rows, every=25) == brute_top(rows, every=25)


def test_search_prunes_clustered_vectors(spark, documents):
    documents()
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    near = centres[rng.integers(0, 40, 4000)] + 0.02 * rng.normal(size=(4000, 16))
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(near)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = vector_search.compared_products(df, pivots=40).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == brute_top(rows)
    compared = {r["query_id"]: r["n_compared"] for r in found}
    assert len(compared) == 80 and sum(compared.values()) < 0.2 * 80 * 4000


def test_search_of_empty_and_repeated_vectors(spark, documents):
    documents()
    rows = [(i, []) for i in range(3)] + [(5, [1.0, -2.0])] * 300 + [(i, [float(i), 1.0]) for i in range(100, 103)]
    assert search(spark, rows, every=50) == brute_top(rows, every=50)


def test_search_of_few_or_no_vectors(spark, documents):
    documents()
    assert search(spark, []) == [] and search(spark, [(50, [1.0])]) == []
    assert search(spark, [(0, [1.0]), (1, [2.0]), (1, [2.0])]) == [(0, 1, 1, 131072), (0, 2, 1, 131072)]


def test_whole_index_is_searched_exactly(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert sorted(map(tuple, vector_search.top_products(vectors).collect())) == brute_top(rows)


MAIL = [
    (1, 0, "user", "Hello there, friend.\nHow are you?"), (1, 1, "assistant", "> How are you?\nFine, thanks."),
    (1, 2, "user", "On Monday, x wrote:\n>> hello THERE friend\n> Fine thanks\nGood"),
    (1, 3, "assistant", "> Hello there, friend.\n> How are you?\nAnother answer"), (1, 4, "user", "ok"), (1, 5, "user", "> nowhere\n\nyes"),
    (1, 6, "u", "> Fine, thanks\nlate"), (2, 0, None, None), (None, 1, "a", "x"), (2, None, "a", ""), (2, 0, None, None),
]
CHAT = "conv_id bigint, turn bigint, role string, text string"


def in_duckdb(name, **tables):
    """The rows of a query's SQL over small tables, with the columns' names."""
    con = duckdb.connect()
    for table_name, frame in tables.items():
        con.register(table_name, frame.toArrow())
    result = con.execute(ORACLES[name])
    return [c[0] for c in result.description], result.fetchall()


def test_quotations_equal_their_sql(spark):
    rng = np.random.default_rng(3)
    lines = ["Hello there, friend.", "How are you?", "ok", "Fine", "", "On Monday x wrote:", "é à!"]
    rows = list(MAIL)
    for conv in range(10, 40):
        for turn in range(8):
            text = "\n".join(">" * int(rng.integers(0, 3)) + " " * int(rng.integers(0, 2)) + lines[rng.integers(0, len(lines))] for _ in range(rng.integers(0, 5)))
            rows.append((conv, turn, "u", text))
    messages = spark.createDataFrame(rows, CHAT)
    names, wanted = in_duckdb("op9_quotation_links", conversations=messages)
    found = [tuple(r) for r in quotations.reply_ordered(messages).select(*names).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    used = {t: table(spark, sf_dir, t) for t in ("embeddings", "conversations")}
    names, wanted = in_duckdb(name, **used)
    found = [tuple(r) for r in QUERIES[name](spark, sf_dir).select(*names).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_quotations_order_replies(spark):
    found = quotations.reply_ordered(spark.createDataFrame(MAIL, CHAT)).orderBy("conv_id", "position").collect()
    assert [(r["conv_id"], r["turn"], r["text"], r["reply_to"], r["n_quoted"], r["n_linked"]) for r in found] == [
        (1, 0, "Hello there, friend.\nHow are you?", None, 0, 0), (1, 1, "Fine, thanks.", 1, 1, 1), (1, 2, "Good", 2, 2, 2), (1, 6, "late", 2, 1, 1),
        (1, 3, "Another answer", 1, 1, 1), (1, 4, "ok", 5, 0, 0), (1, 5, "yes", 6, 1, 0), (2, None, "", None, 0, 0), (2, 0, "", 1, 0, 0),
    ]
    assert found[1]["formatted"] == "<|assistant|>\nFine, thanks.\n" and found[8]["formatted"] == "<||>\n\n"


def test_reply_order_of_a_deep_tree_is_depth_first(spark):
    rng = np.random.default_rng(8)
    texts, parents = {0: "line zero"}, {0: None}
    rows = [(5, 0, "u", "line zero")]
    for i in range(1, 60):
        parent = int(rng.integers(0, i))
        parents[i], texts[i] = parent, f"own words of message {i}"
        rows.append((5, i, "u", f"> {texts[parent]}\n{texts[i]}"))
    order = []

    def visit(node):
        order.append(node)
        for child in [c for c, p in parents.items() if p == node]:
            visit(child)

    visit(0)
    found = quotations.reply_ordered(spark.createDataFrame(rows, CHAT)).orderBy("position").collect()
    assert [r["turn"] for r in found] == order
    assert [r["reply_to_turn"] for r in found] == [parents[n] for n in order]


def test_conversations_without_quotations_keep_their_order(spark, sf_dir):
    messages = table(spark, sf_dir, "conversations")
    found = quotations.reply_ordered(messages).orderBy("conv_id", "position").collect()
    wanted = sorted({tuple(r) for r in messages.select("conv_id", "turn", "role", "text").collect()})
    assert [(r["conv_id"], r["turn"]) for r in found] == [w[:2] for w in wanted]
    assert quotations.reply_ordered(spark.createDataFrame([], CHAT)).count() == 0
    extra = spark.createDataFrame([(1, 0, "u", "> a\nb" + " x" * 50_000, 4, 5)], CHAT + ", position bigint, range bigint")
    assert quotations.reply_ordered(extra).first()["n_quoted"] == 1


def test_quotations_stay_in_the_jvm(spark):
    df = quotations.reply_ordered(spark.createDataFrame(MAIL, CHAT))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


PIPELINE = [
    (1, "the thing and the other one are in the house of the man"), (2, "the thing and the other one are in the house of the man"), (3, "!!! 123 ..."),
    (4, f"the man says {QUESTION}"), (5, "the address of the man is a.b@example.com and nothing else is known of him"), (6, None), (None, "the man and the sea are here today"),
    (7, "the last of the things that are in the list of the man"), (7, "the last of the things that are in the list of the man"),
]


def test_pipeline_stages_take_effect(spark, documents, tmp_path):
    spark.createDataFrame([(1, QUESTION)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(*PIPELINE)
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        kept.append(docs.collect())
        docs = spark.createDataFrame(kept[-1], docs.schema)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == before
    ids = [sorted((r["doc_id"] for r in rows), key=str) for rows in kept]
    assert ids[0] == [1, 2, 4, 5, 7, 7, None]
    assert ids[1] == [1, 4, 5, 7, None] and ids[2] == ids[3] == [1, 5, 7, None]
    assert next(r for r in kept[3] if r["doc_id"] == 5)["text"] == "the address of the man is <EMAIL> and nothing else is known of him"
    assert sorted({r["doc_id"] for r in kept[4]}, key=str) == ids[3]


def test_pipeline_of_nothing_and_of_the_table(spark, documents, sf_dir, tmp_path):
    docs = documents()
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
    assert corpus_pipeline.run(spark, sf_dir).count() > 100


def test_pipeline_decides_by_row(spark, documents, tmp_path):
    spark.createDataFrame([(1, QUESTION)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean, other = "the thing and the other one are in the house of the man", "the last of the things that are in the list of the man"
    rows = [(7, clean), (7, other), (7, f"the man says {QUESTION}"), (7, "!!! 123 ..."), (None, clean), (None, f"the man asks {QUESTION}"), (None, "..."), (7, other)]
    docs = documents(*rows)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
    assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == [(7, other), (7, clean)]


def test_pipeline_keeps_what_brute_force_keeps(spark, documents, sf_dir):
    documents()
    texts = [(r["doc_id"], r["text"] or "") for r in table(spark, sf_dir, "documents").collect()]
    items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    rows = [(d, t) for d, t in texts if any(c.isalpha() for c in t)]
    roots = brute(rows)
    wanted = {d for d, t in rows if roots[d] == d and not any(item in t for item in items)}
    found = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().collect()}
    assert found <= wanted and len(found) >= len(wanted) - 1


def test_every_dealt_operator_has_a_query():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {name.split("_")[0] for name in QUERIES}


@pytest.mark.parametrize("name", ["op1_template_decontamination", "op3_language_fusion", "op9_quotation_links"])
def test_queries_cover_their_tables(spark, sf_dir, name):
    source = {"op9_quotation_links": ["conversations"], "op3_language_fusion": ["documents", "pages"]}.get(name, ["documents"])
    assert QUERIES[name](spark, sf_dir).count() == sum(table(spark, sf_dir, t).count() for t in source)
