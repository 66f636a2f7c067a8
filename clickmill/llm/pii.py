"""Personal data: fixed patterns, and candidates of loose generators that boosted trees accept or refuse.

Generators propose many overlapping spans: numbers with separators, addresses written out, identity numbers. Trees over
format and context features score each one; a span is redacted if its score reaches the threshold of its kind, calibrated on
held-out rows for PRECISION. Where that leaves less than LEAST_RECALL of the held-out true spans of a kind, strict training
fails; finding and redacting take the threshold that keeps LEAST_RECALL and warn. Of overlapping accepted spans the one with
the highest score stays, and none that overlaps a base span.

The trees are trained here: true forms and look-alikes (order numbers, versions, dates, amounts) are set into contexts
drawn from a bounded sample of the documents (SAMPLE_DOCS), so that the labels are known. Every shape of a generator has true
forms. A bare run of digits, or pairs of digits without a leading zero, can only be told by a word before it that says so.

Defined results: a null text counts as empty and has no spans (and stays null when redacted); repeated rows get equal
results; a null doc_id stays null; an empty table gives no rows; further columns are ignored, and kept when redacting.
Spans are in code points of the whole text.
"""

from __future__ import annotations

import random
import re
import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm import boosting
from clickmill.llm.common import claim, sampled
from clickmill.llm.spans import Cover, Span, free_of, joined, sha256
from clickmill.llm.tokens import portions

KINDS = ("email", "ip", "card", "phone", "contact", "identity")
# The patterns and limits of the base kinds.
_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, IP_PART = (14, 19), (10, 15), 255

SAMPLE_DOCS = 200
TRAIN_FORMS = 3_000
PRECISION, LEAST_RECALL = 0.995, 0.9
SEED = 7
CONTEXT = 24
# Signs of a context word that training keeps: a text without blanks is one word.
WORD_SIGNS = 32

_GENERATORS = {
    "contact": re.compile(
        r"(?<![0-9+])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])"
        r"|(?<![0-9+])0[0-9]{2,4}[ /-][0-9]{3,4}[ -]?[0-9]{3,5}(?![0-9])"
        # In pairs, and with 00 for abroad.
        r"|(?<![0-9+])[0-9]{2}(?:[ .-][0-9]{2}){3,4}(?![0-9])"
        r"|(?<![0-9+])0[0-9]{2,4}[ ./-][0-9]{2,3}(?:[ .-][0-9]{2}){2,3}(?![0-9])"
        r"|(?<![0-9+])00[1-9](?:[ ()./-]{0,2}[0-9]){8,13}(?![0-9])"
    ),
    "identity": re.compile(
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
        r"|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
        r"|(?<![0-9])[0-9]{2,4}[./-][0-9]{2,4}[./-][0-9]{2,4}(?![0-9])"
        r"|(?<![0-9])[0-9]{8,12}(?![0-9])"
    ),
}
_WRITTEN_OUT = re.compile(
    r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,40}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{2,40}+(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z]{2,24}+)+"
)
_CUES = re.compile(r"(?i)\b(?:call|phone|tel|mobile|fax|mail|contact|write|ssn|iban|account|id|passport|social)\b")
# The same words with at most one other between them and the span.
_NEAR_CUES = re.compile(_CUES.pattern + r"(?:\W+[A-Za-z]+)?[^\w+]*$")
_ANTI_CUES = re.compile(r"(?i)\b(?:order|version|invoice|date|on|since|release|ref|no|nr|item|total|page|year)\b")


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost non-overlapping addresses. Only what stands around an @ can be one, so the search goes from @ to @."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        domain = _EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; those that fail a check are dropped."""
    found = list(_emails(text))
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part or "0") <= IP_PART for part in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _digits(m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
                found.append(("phone", m.start(), m.end()))
    return found


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of all generators."""
    found = [(kind, m.start(), m.end()) for kind, pattern in _GENERATORS.items() for m in pattern.finditer(text)]
    if "at]" in text or "at)" in text:
        found += [("contact", m.start(), m.end()) for m in _WRITTEN_OUT.finditer(text)]
    return found


def _valid_iban(form: str) -> bool:
    form = form.replace(" ", "")
    if not re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", form):
        return False
    return int("".join(str(int(c, 36)) for c in form[4:] + form[:4])) % 97 == 1


def features(text: str, span: Span) -> list[float]:
    """Format of the span and its context; none says how a training row was made."""
    kind, start, end = span
    form, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = re.findall("[0-9]+", form)
    digits = "".join(groups)
    return [
        float(kind == "contact"), float(len(form)), float(len(digits)), float(len(groups)),
        float(len(groups[0]) if groups else 0), float(len(groups[-1]) if groups else 0),
        float(max(map(len, groups), default=0)), float(form.count("-")), float(form.count(".")), float(form.count(" ")),
        float(form.count("/")), float("(" in form), float("at" in form.lower() and not digits[:1]),
        float("dot" in form.lower()), float(sum(c.isalpha() for c in form)), float(form[:1] == "0"),
        float(_valid_iban(form)), float(bool(_CUES.search(before))), float(bool(_ANTI_CUES.search(before))),
        float(before[-1:].isalnum()), float(before[-1:] in "#$€£"), float(after[:1].isalnum()), float(after[:1] == "%"),
        float(1 <= int(groups[1]) <= 12 if len(groups) == 3 and len(groups[1]) == 2 else 0),
        float(bool(_NEAR_CUES.search(before))), float(form[:2] == "00"), float(sum(len(g) == 2 for g in groups)),
    ]


def _known_forms(draw: random.Random) -> tuple[list[tuple[str, str, bool]], list[tuple[str, str, bool]]]:
    """True forms and look-alikes: cue, form, and whether the form means nothing without its cue."""

    def number(n: int) -> str:
        return str(draw.randint(1, 9)) + "".join(str(draw.randint(0, 9)) for _ in range(n - 1))

    def iban() -> str:
        country, account = draw.choice(["DE", "FR", "ES", "GB"]), number(18)
        check = 98 - int("".join(str(int(c, 36)) for c in account + country + "00")) % 97
        plain = f"{country}{check:02d}{account}"
        return " ".join(plain[i : i + 4] for i in range(0, len(plain), 4)) if draw.random() < 0.5 else plain

    name = "".join(draw.choice("abcdefghijklmnoprstuvw") for _ in range(draw.randint(3, 9)))
    host = "".join(draw.choice("abcdefghijklmnoprstuvw") for _ in range(draw.randint(4, 9)))
    month, day, year = f"{draw.randint(1, 12):02d}", f"{draw.randint(1, 28):02d}", str(draw.randint(1950, 2030))
    pairs = [number(2) for _ in range(4)]
    dot = draw.choice(" .-")
    phone, person = draw.choice(["call ", "phone ", "tel ", "mobile: ", "fax "]), draw.choice(["account ", "passport ", "id ", "social "])
    true = [
        ("call ", f"({number(3)}) {number(3)}-{number(4)}", False), ("phone ", f"{number(3)}-{number(3)}-{number(4)}", False),
        ("tel ", f"{number(3)}.{number(3)}.{number(4)}", False), ("tel ", f"0{number(3)} {number(3)}{number(4)}", False),
        (phone, f"0{number(1)}{dot}{dot.join(pairs)}", False), (phone, f"0{number(2)} {number(3)} {pairs[0]} {pairs[1]}", False),
        (phone, dot.join(pairs), True), (phone, f"00{number(2)} {number(draw.randint(1, 3))} {number(draw.randint(6, 7))}", False),
        (phone, f"00{number(draw.randint(9, 12))}", True), (phone, number(draw.randint(8, 12)), True),
        ("mail ", f"{name} [at] {host} [dot] {draw.choice(['com', 'org', 'net'])}", False),
        ("contact ", f"{name}(at){host}.{draw.choice(['com', 'org', 'net'])}", False),
        ("ssn ", f"{number(3)}-{number(2)}-{number(4)}", False), ("iban ", iban(), False),
        (person, number(draw.randint(8, 12)), True), (person, f"{number(3)}-{number(3)}-{number(3)}", True),
    ]
    false = [
        ("order ", number(draw.randint(8, 12)), False), ("on ", f"{year}-{month}-{day}", False), ("date ", f"{day}.{month}.{year}", False),
        ("version ", f"{draw.randint(10, 99)}.{draw.randint(10, 99)}.{draw.randint(100, 999)}", False),
        ("ref ", f"{number(2)}-{number(3)}-{number(2)}", False), ("total ", number(9), False),
        ("item ", draw.choice(["AB", "XK"]) + number(2) + " " + " ".join(number(4) for _ in range(4)), False),
        ("invoice ", f"{number(4)}/{number(3)}/{number(2)}", False),
        ("no ", dot.join(pairs), False), ("item ", f"00{number(draw.randint(9, 12))}", False), ("ref ", f"{number(3)}-{number(3)}-{number(3)}", False),
    ]
    return true, false


def _forms(draw: random.Random) -> tuple[str, str, int]:
    """cue, form, label: a true form or a look-alike."""
    known = _known_forms(draw)
    label = draw.randint(0, 1)
    cue, form, cued = draw.choice(known[0 if label else 1])
    # Cues are a hint only: half of the forms come without theirs, if they can.
    return (cue if cued or draw.random() < 0.5 else ""), form, label


class Model:
    """The trees with the threshold of each kind."""

    def __init__(self, trees: list, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def accepted(self, text: str, base: Sequence[Span]) -> list[Span]:
        """The candidates beside the base spans that reach the threshold of their kind; the best of those that overlap."""
        proposed = free_of(candidates(text), base)
        if not proposed or not self.trees:
            return []
        score = boosting.predicted(self.trees, np.array([features(text, s) for s in proposed]))
        kept, cover = [], Cover()
        for at in np.argsort(-score, kind="stable").tolist():
            kind, start, end = proposed[at]
            if score[at] >= self.thresholds[kind] and not cover.meets(start, end):
                cover.add(start, end)
                kept.append(proposed[at])
        return kept


def threshold(score: np.ndarray, known: np.ndarray, kind: str, strict: bool) -> float:
    """The score from which held-out spans are true with PRECISION.

    Where that leaves less than LEAST_RECALL of the true ones: an error if ``strict``, else the score that keeps so many.
    """
    precise = boosting.calibrated_threshold(score, known, PRECISION)
    true = np.sort(score[known == 1])
    recall = np.mean(true >= precise)
    if recall >= LEAST_RECALL:
        return precise
    lack = f"personal data of kind {kind}: recall {recall:.3f} at precision {PRECISION}, less than {LEAST_RECALL}"
    if strict:
        raise ValueError(lack)
    if not len(true):
        return precise
    lower = float(true[int((1 - LEAST_RECALL) * len(true))])
    warnings.warn(f"{lack}; precision {np.mean(known[score >= lower]):.3f} at recall {LEAST_RECALL} instead", stacklevel=2)
    return lower


def train(docs: DataFrame, sample: int = SAMPLE_DOCS, forms: int = TRAIN_FORMS, seed: int = SEED, strict: bool = True) -> Model:
    """Trees from known forms in contexts of at most ``sample`` documents; one half is held out for the thresholds.

    ``strict``: fail where a kind reaches no sufficient recall, instead of lowering its threshold with a warning.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    # From each sampled document a bounded number of its words, evenly spread over the whole text, the start of each.
    words = F.expr("split(text, ' ')")
    word = lambda i: F.substring(F.get(words, (F.size(words) * i / 64).cast("int")), 1, WORD_SIGNS)
    some = F.transform(F.sequence(F.lit(0), F.lit(63)), word)
    drawn = sampled(texts.select("doc_id", some.alias("words")), sample, "doc_id").collect()
    # A cue that stands there by chance would make a look-alike a true form.
    contexts = [[word for word in row["words"] if word and not _CUES.search(word)] for row in drawn]
    contexts = [c for c in contexts if len(c) > 3] or [["a", "text", "without", "more"]]
    draw = random.Random(seed)
    rows, labels, kinds = [], [], []
    for _ in range(forms):
        cue, form, label = _forms(draw)
        words_of = draw.choice(contexts)
        before, after = (" ".join(draw.choice(words_of) for _ in range(4)) for _ in range(2))
        start = len(before) + 1 + len(cue)
        text = f"{before} {cue}{form} {after}"
        for span in candidates(text):
            if span[1] < start + len(form) and start < span[2]:
                rows.append(features(text, span))
                labels.append(label)
                kinds.append(span[0])
    x, y = np.array(rows), np.array(labels, float)
    half = len(y) // 2
    trees = boosting.fitted(x[:half], y[:half])
    score, known, kind = boosting.predicted(trees, x[half:]), y[half:], np.array(kinds[half:])
    thresholds = {}
    for name in _GENERATORS:
        of_kind = kind == name
        thresholds[name] = threshold(score[of_kind], known[of_kind], name, strict)
    return Model(trees, thresholds)


def _scanned(model: Model):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                kinds = [kind for kind, _, _ in base]
                counts = [kinds.count(kind) for kind in KINDS[:4]]
                added = model.accepted(text or "", base)
                rows.append((*counts, sha256(joined(base, KINDS)), joined(base + added, KINDS)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()] * 2, strict=True)]
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return scan


def personal_data(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row per row of doc_id, text."""
    model = train(docs, sample, strict=False)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    columns = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return texts.mapInArrow(_scanned(model), columns)


def redacted(text: str, model: Model) -> str:
    """The text with every span replaced by the name of its kind; overlapping spans become one."""
    base = base_spans(text)
    spans = sorted(base + model.accepted(text, base), key=lambda s: (s[1], -s[2]))
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _redacted(model: Model, place: int):
    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for batch in portions(batches, place):
            texts = [None if t is None else redacted(t, model) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return redact


def redact(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """The documents with their personal data replaced; all other columns stay as they are."""
    return docs.mapInArrow(_redacted(train(docs, sample, strict=False), docs.columns.index("text")), docs.schema)
