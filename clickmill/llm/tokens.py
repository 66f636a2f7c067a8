"""Texts as ids of a public tokenizer.

Both vocabularies used here cut a text into pieces first and encode each piece by itself. A text is therefore split where
a cut is certain, and the ids of each part are kept: parts recur, and the library is asked once per new part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clickmill.llm.common import claim, give_back, kept

# Known parts of a worker; beyond this number it forgets all but the first CORE_PARTS, which hold most of the frequent ones.
CACHE_PARTS = 500_000
CORE_PARTS = 250_000
# Texts that are worked on at a time, so that a worker's memory does not follow the size of its batches.
PORTION_BYTES = 1 << 20
# New words that the library is asked for in one text.
JOINED_WORDS = 64

# Signs after a letter (ASCII or Latin-1, as UTF-8) and up to white space: the vocabularies always cut before the signs.
_SIGNS = re.compile(
    rb"([.,;:!?](?:(?<=[A-Za-z][.,;:!?])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][.,;:!?]))[.,;:!?]*)(?=[ \n]|$)"
)
# The same with other signs, for the spaced vocabulary: it cuts between letters and signs, and its special names hold none of these.
_MORE_SIGNS = re.compile(
    rb"([!-&(-;=?@\[-`{}~](?:(?<=[A-Za-z][!-/:-@\[-`{-~])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][!-/:-@\[-`{-~]))[!-&(-/:;=?@\[-`{}~]*)(?=[ \n]|$)"
)
_TWO_BLANKS = re.compile(rb"[\x09-\x0d\x1c-\x20][\x09-\x0d\x1c-\x20]")
# First bytes of white space beyond ASCII, and of some other signs.
_FAR_BLANKS = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2[\x80\x81]|\xe3\x80\x80")
# A space before something that is not white space.
_INNER_SPACE = re.compile(rb" (?![\x09-\x0d\x1c-\x20]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2[\x80\x81]|\xe3\x80\x80|$)", re.S)

# How a piece vocabulary writes a blank.
BLANK_SIGN = "\u2581"
_BLANKS_AND_WORD = re.compile(rb" +[^ ]*")


def _gaps(ids: list[bytes | None]) -> list[int]:
    """Where the list holds None."""
    found = []
    at = -1
    for _ in range(ids.count(None)):
        at = ids.index(None, at + 1)
        found.append(at)
    return found


class PartEncoder:
    """Ids of UTF-8 texts as little-endian unsigned 32-bit bytes.

    ``spaced``: white space belongs to the parts (a single space to the part after it) and case matters; otherwise parts
    are separated by white space, which has no ids, and compared in lower case. A spaced part that starts with a zero
    byte stands for the rest of it, without a space before. ``plain``: the names of special tokens are ordinary text.
    """

    def __init__(self, path: str, spaced: bool, plain: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.spaced = spaced
        self.known: dict[bytes, bytes] = {}
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        # Where a word begins (a space) or ends, seen from its ids.
        self.edge = np.array([n.startswith("Ġ") if spaced else n.endswith("</w>") for n in names], bool)

    def _split(self, text: bytes) -> list[bytes]:
        if not self.spaced:
            return _SIGNS.sub(rb" \1", text if b"<|" in text else text.lower()).split()
        if b"\0" in text:
            # The mark itself occurs: the whole text is one part, as texts with zero bytes are rare.
            return [b"\0" + text]
        cut = b"\0" + _MORE_SIGNS.sub(rb" " + b"\0" + rb"\1", text)
        if not _TWO_BLANKS.search(text) and (text.isascii() or not _FAR_BLANKS.search(text)):
            return cut.replace(b"\n", b" \0\n \0").split(b" ")
        return _INNER_SPACE.split(cut)

    def _ask(self, texts: list[str]) -> list[bytes]:
        encodings = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encodings]

    def _text_of(self, part: bytes) -> str:
        if not self.spaced:
            return part.decode()
        return part[1:].decode() if part[:1] == b"\0" else " " + part.decode()

    def _learn(self, parts: list[bytes]) -> None:
        """Fill ``known``. Plain words are asked for side by side, and told apart by the edges of words in their ids."""
        words, rest = [], []
        for part in parts:
            (words if part.decode().isalpha() else rest).append(part)
        groups = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        lead = " " if self.spaced else ""
        for group, ids in zip(groups, self._ask([lead + b" ".join(g).decode() for g in groups]), strict=True):
            edges = np.flatnonzero(self.edge[np.frombuffer(ids, "<u4")])
            if len(edges) != len(group):
                rest += group
                continue
            cuts = (4 * np.append(edges, len(ids) // 4) if self.spaced else 4 * np.append(0, edges + 1)).tolist()
            self.known.update(zip(group, [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], strict=True))
        self.known.update(zip(rest, self._ask([self._text_of(p) for p in rest]), strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > CACHE_PARTS:
            self.known = dict(islice(self.known.items(), CORE_PARTS))
        split = [self._split(text) for text in texts]
        # Each part is looked up once; only those not found then are looked up again.
        found = [list(map(self.known.get, parts)) for parts in split]
        gaps = [_gaps(ids) for ids in found]
        new = {parts[at] for parts, missing in zip(split, gaps, strict=True) for at in missing}
        if new:
            self._learn(list(new))
        for parts, ids, missing in zip(split, found, gaps, strict=True):
            for at in missing:
                ids[at] = self.known[parts[at]]
        return [b"".join(ids) for ids in found]


class PieceEncoder:
    """Ids of UTF-8 texts that begin with a space, by a vocabulary in which that space is part of the first piece.

    No piece holds a blank after another sign, so a cut before each run of blanks is certain (the constructor checks it).
    """

    def __init__(self, path: str):
        self.processor = SentencePieceProcessor(model_file=path)
        names = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        if any(BLANK_SIGN in name.lstrip(BLANK_SIGN) for name in names):
            raise ValueError(f"{path}: pieces with inner blanks cannot be encoded in parts")
        self.blank = np.array([names.index(BLANK_SIGN)], "<u4").tobytes()
        self.known: dict[bytes, bytes] = {}

    def _learn(self, parts: list[bytes]) -> None:
        # The library puts the first blank before a text by itself, but not before an empty one.
        found = self.processor.encode([part[1:].decode() for part in parts], num_threads=1)
        self.known.update((part, np.array(ids, "<u4").tobytes()) for part, ids in zip(parts, found, strict=True))
        self.known[b" "] = self.blank

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > CACHE_PARTS:
            self.known.clear()
        split = [_BLANKS_AND_WORD.findall(text) for text in texts]
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(list(new))
        return [b"".join(map(self.known.__getitem__, parts)) for parts in split]


_ENCODERS: dict[tuple, PartEncoder | PieceEncoder] = kept({})


def encoder(path: str, spaced: bool, plain: bool = False) -> PartEncoder:
    """One encoder for each vocabulary and worker, while its tasks follow each other."""
    claim(_ENCODERS)
    if (path, spaced, plain) not in _ENCODERS:
        _ENCODERS[path, spaced, plain] = PartEncoder(path, spaced, plain)
    return _ENCODERS[path, spaced, plain]


def piece_encoder(path: str) -> PieceEncoder:
    """One encoder for each vocabulary and worker, while its tasks follow each other."""
    claim(_ENCODERS)
    if (path,) not in _ENCODERS:
        _ENCODERS[path,] = PieceEncoder(path)
    return _ENCODERS[path,]


def text_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null is the empty text."""
    return [value or b"" for value in column.cast("binary").to_pylist()]


def portions(batches: Iterator[pa.RecordBatch], texts: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about PORTION_BYTES of the text column; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False)
        number = (np.cumsum(sizes) - sizes) // PORTION_BYTES
        starts = np.flatnonzero(np.diff(number, prepend=-1)).tolist()
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)
        del batch
    give_back()
