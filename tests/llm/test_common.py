"""Helpers that the operators share."""

import pyarrow as pa
import public_tokenizers

from clickmill.llm import decontamination, near_dedup, packing, pii, tokens
from clickmill.llm.common import BATCH_BYTES, stored


def test_stored_frames_reach_python_in_bounded_batches(spark):
    option = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(option)

    def batch_sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    texts = spark.range(0, 60, 1, 1).selectExpr("repeat('x', 500000) as text")
    found = stored(texts.mapInArrow(batch_sizes, "n bigint, bytes bigint"), "batches").collect()
    assert sum(row["n"] for row in found) == 60
    assert max(row["bytes"] for row in found) <= BATCH_BYTES + 500_100
    assert spark.conf.get(option) == before


def test_a_worker_gives_up_what_other_operators_left():
    def run(function, **more):
        batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["one two three four five six seven"]} | more)
        return sum(found.num_rows for found in function(iter([batch])))

    def held():
        kept = {"packing": tokens._ENCODERS, "near_dedup": near_dedup._WORDS, "decontamination": decontamination._WORDS.parts}
        return {name for name, cache in kept.items() if cache}

    def pack():
        return run(packing._pieces_of(public_tokenizers.path("byte_bpe_50k.json"), 0, 2048))

    # As the stages of the pipeline follow each other in one worker, over one input and then the next.
    assert pack() == 1 and held() == {"packing"}
    assert run(near_dedup._signed(32, 4, 5)) == 1 and held() == {"near_dedup"}
    assert run(decontamination._template_windows(None)) == 3 and held() == {"decontamination"}
    assert pack() == 1 and held() == {"packing"}
    assert run(near_dedup._full_sets(5)) == 1 and held() == {"near_dedup"}
    assert list(near_dedup._linked(iter([]))) == [] and held() == set()
    assert pack() == 1 and held() == {"packing"}
    assert run(pii._redacted(pii.Model([], {}), 1)) == 1 and held() == set()
    assert pack() == 1 and held() == {"packing"}
    # Tasks of one operator keep what it knows.
    codes = tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"), spaced=True)
    assert pack() == 1 and tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"), spaced=True) is codes and codes.known


def test_template_words_keep_the_first_parts_when_there_are_too_many(monkeypatch):
    def found(words):
        words.clear()
        results = []
        for at in range(0, 60, 3):
            # Frequent parts, parts of several template words or none, and ever new ones.
            texts = [[b"the", b"Seven", b"--", b"well-known", b"12", b"km", *(b"new%d-x" % i for i in range(at, at + 3))]]
            words.learn(set().union(*texts))
            results.append([column.tolist() for column in words.template(texts)])
            assert len(words.value) == len(words.flags) == sum(map(len, words.parts.values())) // 4
        return results

    wanted = found(decontamination.TemplateWords())
    monkeypatch.setattr(decontamination, "CACHE_WORDS", 16)
    monkeypatch.setattr(decontamination, "CORE_WORDS", 9)
    words = decontamination.TemplateWords()
    assert found(words) == wanted
    assert len(words.parts) <= 20 and {b"the", b"well-known", b"--"} <= set(words.parts)
    # Parts of very many template words leave no core.
    monkeypatch.setattr(decontamination, "CACHE_WORDS", 4)
    assert found(words) == wanted
