"""Decontamination against plain loops over windows, alignments and slots."""

import math
from collections import Counter, defaultdict

import numpy as np

from clickmill.llm import decontamination

WORDS = "river stone apple walks near under".split()
NAMES = "Anna Peter Maria".split()


def words_of(text):
    """(code, kind, value) of each word of an ASCII text; a code is the word, or the name of its kind."""
    found, ended, after_number = [], True, False
    for part in (text or "").split():
        word = part.rstrip(".,;:!?")
        if not word:
            continue
        if word.isdigit():
            kind = "number"
        elif after_number and word.lower() in decontamination.UNITS:
            kind = "unit"
        elif not ended and len(word) > 1 and word[0].isupper() and word[1:].islower():
            kind = "name"
        else:
            kind = None
        found.append((("kind", kind) if kind else ("word", word.lower()), kind, word.lower()))
        ended, after_number = part[-1] in ".!?", kind == "number"
    return found


def item_windows(words):
    """(place, literal, width) of the windows of an item."""
    if 0 < len(words) < 5:
        return [(0, True, len(words))]
    return [(at, sum(kind is not None for _, kind, _ in words[at : at + 5]) > 2, 5) for at in range(len(words) - 4)]


def matches(doc, item, window):
    """Places of the document where the item's window is, with the pairs of slots (position, item's value, document's value)."""
    at, literal, width = window
    wanted = item[at : at + width]
    slots = [i for i, (_, kind, _) in enumerate(wanted) if kind]
    for place in range(len(doc) - width + 1):
        here = doc[place : place + width]
        if literal or not slots:
            if [w[2] for w in here] == [w[2] for w in wanted]:
                yield place, frozenset()
                if width < 5:
                    return
        elif [w[0] for w in here] == [w[0] for w in wanted]:
            yield place, frozenset((at + i, wanted[i][2], here[i][2]) for i in slots)


def consistent(windows):
    """Of one alignment's windows (place, literal, pairs) those that count."""
    spots = set().union(*(pairs for _, _, pairs in windows))
    bound = {(item, doc) for _, item, doc in spots}
    values = {item for item, _ in bound}
    if len(bound) == len(values):
        return windows
    places, same = Counter(item for _, item, _ in spots), Counter((item, doc) for _, item, doc in spots)
    binding = {pair for pair in bound if 2 * same[pair] > places[pair[0]]}
    decided = len(binding) == len(values)
    kept = set()
    for window in windows:
        unchanged = all(item == doc for _, item, doc in window[2])
        if unchanged or (decided and all((item, doc) in binding for _, item, doc in window[2])):
            kept.add(window)
    return kept


def needed(total):
    return max(math.ceil(total / 2), min(total, 5))


def brute(docs, items):
    """(doc_id, item_id): coverage, aligned, reparameterised."""
    found = {}
    for doc_id, doc in ((i, words_of(t)) for i, t in docs):
        for item_id, item in ((i, words_of(t)) for i, t in items):
            windows, by_shift = item_windows(item), defaultdict(set)
            for window in windows:
                for place, pairs in matches(doc, item, window):
                    by_shift[place - window[0]].add((window[0], window[1], pairs))
            covered, aligned, changed = set(), 0, {}
            for kept in map(consistent, by_shift.values()):
                places = {(place, literal) for place, literal, _ in kept}
                other = any(a != b for _, _, pairs in kept for _, a, b in pairs)
                covered |= places
                aligned = max(aligned, len(places))
                for place in places:
                    changed[place] = changed.get(place, True) and other
            total, template = len(windows), sum(not literal for _, literal, _ in windows)
            of_template = sum(not literal for _, literal in covered)
            enough = total and len(covered) >= needed(total)
            if enough or (template and of_template >= needed(template)) or aligned >= 9:
                coverage = max(len(covered) / total, of_template / template if template else 0)
                found[doc_id, item_id] = (round(coverage, 9), aligned, any(changed.values()))
    return found


def random_text(rng, n):
    """Words, names, numbers, numbers with a unit, and ends of sentences."""
    parts = []
    while len(parts) < n:
        draw = rng.random()
        if draw < 0.6:
            parts.append(str(rng.choice(WORDS)))
        elif draw < 0.75:
            parts.append(str(rng.choice(NAMES)))
        elif draw < 0.9:
            parts.append(str(rng.integers(1, 5)))
        else:
            parts += [str(rng.integers(1, 5)), "km"]
        if rng.random() < 0.1:
            parts[-1] += "."
    return " ".join(parts[:n])


def edited(rng, text):
    """The text with some numbers and names replaced, by one rule or at random places, or with a word changed."""
    parts, way = text.split(), rng.integers(0, 4)
    rule = {str(i): str(rng.integers(1, 9)) for i in range(1, 5)} | {name: str(rng.choice(NAMES)) for name in NAMES}
    for i, part in enumerate(parts):
        core = part.rstrip(".")
        if core in rule and (way == 1 or (way == 2 and rng.random() < 0.3)):
            parts[i] = rule[core] + part[len(core) :]
        elif way == 3 and rng.random() < 0.1:
            parts[i] = str(rng.choice(WORDS))
    return " ".join(parts)


def test_leaks_equal_plain_loops(spark, documents):
    documents()
    rng = np.random.default_rng(17)
    items = [(i, random_text(rng, int(rng.integers(1, 30)))) for i in range(40)] + [(40, ""), (41, None), (42, "apple"), (43, "river " * 12)]
    docs = [(i, random_text(rng, int(rng.integers(0, 60)))) for i in range(60)] + [(500, None), (501, ""), (502, "river " * 40)]
    for i in range(60, 200):
        pieces = [edited(rng, items[int(rng.integers(0, 40))][1]) for _ in range(int(rng.integers(1, 4)))]
        docs.append((i, f" {random_text(rng, 3)} ".join(pieces)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()
    found = {(r["doc_id"], r["item_id"]): (round(r["coverage"], 9), r["aligned"], r["reparameterised"]) for r in rows}
    assert len(found) == len(rows) > 100
    assert found == brute(docs, items)


def test_bitmap_grows_with_the_benchmark(spark, documents, monkeypatch):
    """The same leaks from a bitmap so small that most windows pass, and from one sized by the windows."""
    documents()
    rng = np.random.default_rng(5)
    items = [(i, random_text(rng, 12)) for i in range(300)]
    docs = [(i, edited(rng, items[i][1])) for i in range(100)]
    frames = [spark.createDataFrame(r, f"{k} bigint, text string") for k, r in (("doc_id", docs), ("item_id", items))]
    expected = sorted(map(tuple, decontamination.leaks(*frames).collect()))
    assert decontamination.bitmap_bits(300) == decontamination.BITMAP_BITS < decontamination.bitmap_bits(10**6) <= decontamination.MOST_BITMAP_BITS
    assert decontamination.bitmap_bits(10**12) == decontamination.MOST_BITMAP_BITS
    monkeypatch.setattr(decontamination, "BITMAP_BITS", 1 << 15)
    monkeypatch.setattr(decontamination, "MOST_BITMAP_BITS", 1 << 15)
    assert sorted(map(tuple, decontamination.leaks(*frames).collect())) == expected
