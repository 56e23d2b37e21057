"""Token ids of whole texts by a byte-level BPE file, with each piece between spaces encoded once.

The tokenizer splits a text before every space that stands between two other characters, and nothing is
merged across. So the ids of a text are those of its pieces, and pieces repeat.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What a task keeps of the pieces it has encoded: their number, and their bytes.
CACHED_PIECES, CACHED_BYTES = 800_000, 64 << 20
#: Characters of text that are encoded together, about, and new pieces that are.
STEP = 1 << 23
TOGETHER = 1000
#: Pieces whose ids are gathered at a time.
GATHERED = 1 << 18
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: White space but the blank; where one stands beside a blank, a text is not split at that blank.
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
_COMMON, _RARE = ("\n", "\t", "\r"), [c for c in _SPACES if c not in "\n\t\r"]


def _is_odd(text: str) -> bool:
    """Whether a blank stands at an end or beside other white space."""
    if not text or text[0] == " " or text[-1] == " " or "  " in text:
        return True
    rare = [c for c in _RARE if c in text] if not text.isascii() or not text.isprintable() else ()
    return any(f" {c}" in text or f"{c} " in text for c in (*_COMMON, *rare))


#: Marks that are split off a letter or digit before them, as the byte-level pattern does.
_MARKS = ".,;:!?"


def _parts(piece: str) -> list[str]:
    """What a piece is made of: lines and the ends of lines, and marks behind a letter or digit, each on its own.

    A line end between characters that are no white space is a token of its own, and the next line starts anew.
    """
    lines, out = piece.split("\n"), []
    if len(lines) > 1 and not all(x and x == x.strip() for x in lines):
        lines = [piece]
    for line in lines:
        core = line.rstrip(_MARKS)
        out += ["\n"] if out else []
        out += [core, line[len(core) :]] if core != line and core[-1:].isalnum() else [line]
    return out


class _Pieces(dict):
    """Piece without its leading space -> its number; new pieces wait to be encoded.

    A piece that is made of several parts shares these with many others.
    """

    def __init__(self, owner: Encoder, lead: str):
        self.owner, self.lead = owner, lead

    def __missing__(self, piece: str) -> int:
        owner = self.owner
        parts = () if piece.isalpha() else _parts(piece)
        if len(parts) > 1:
            owner.parts += (self[parts[0]], *map(owner.first.__getitem__, parts[1:]))
            number = self[piece] = owner.pieces
            owner.made.append(number)
            owner.made_of.append(len(parts))
        else:
            number = self[piece] = owner.pieces
            owner.waiting.append(self.lead + piece)
            owner.numbers.append(number)
        owner.pieces = number + 1
        return number


class Encoder:
    """Encodes by a byte-level BPE file that splits texts before blanks; other files are refused."""

    def __init__(self, path: str):
        # A task has one core; threads of the library would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if not self._splits_at_blanks():
            raise ValueError(f"{path} does not split texts before single blanks, so its pieces cannot be encoded alone")
        vocabulary = self.tokenizer.get_vocab()
        #: UTF-8 bytes of each token: a byte-level vocabulary has one character for each byte.
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes[number] = len(token)
        self.clear()

    def _splits_at_blanks(self) -> bool:
        """Whether the file is byte-level BPE with its usual pattern, changes no text and adds no token with a blank."""
        parts = json.loads(self.tokenizer.to_str())
        step = parts.get("pre_tokenizer") or {}
        return (
            parts["model"]["type"] == "BPE"
            and step.get("type") == "ByteLevel"
            and step.get("use_regex", True)
            and not step.get("add_prefix_space", True)
            and not parts.get("normalizer")
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in parts.get("added_tokens", []))
        )

    def clear(self) -> None:
        self.waiting: list[str] = []  # pieces to encode, and their numbers
        self.numbers: list[int] = []
        self.made: list[int] = []  # pieces made of others, of how many, and these
        self.made_of: list[int] = []
        self.parts: list[int] = []
        self.pieces = self.held = 0
        self.ids = np.empty(0, np.uint32)
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.first, self.later = (_Pieces(self, lead) for lead in ("", " "))

    def _encode_waiting(self) -> None:
        # Texts of many pieces; what could merge with its neighbour is a text of its own.
        alone = [k for k, p in enumerate(self.waiting) if p[:1] != " " or p.strip() != p[1:] or len(p) == 1]
        texts, start = [], 0
        for end in (*alone, len(self.waiting)):
            texts += [self.waiting[k : min(k + TOGETHER, end)] for k in range(start, end, TOGETHER)]
            texts += [[self.waiting[end]]] if end < len(self.waiting) else []
            start = end + 1
        joined = ["".join(x) for x in texts]
        encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        grown = self.pieces - len(self.size)
        self.start, self.size = (np.concatenate([x, np.zeros(grown, np.int64)]) for x in (self.start, self.size))
        if texts:
            ids = np.concatenate([np.array(x.ids, np.uint32) for x in encoded])
            # Texts, pieces and tokens end at the same bytes.
            sizes = pc.binary_length(pa.array(self.waiting, pa.string())).to_numpy()
            n = np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(sizes), side="right"), prepend=0)
            self.size[self.numbers], self.start[self.numbers] = n, len(self.ids) + np.cumsum(n) - n
            self.ids = np.concatenate([self.ids, ids])
            self.held += sum(map(len, joined))
        if self.parts:
            flat, ends = self._gathered(np.array(self.parts))
            n = np.diff(ends[np.cumsum(self.made_of) - 1], prepend=0)
            self.size[self.made], self.start[self.made] = n, len(self.ids) + np.cumsum(n) - n
            self.ids = np.concatenate([self.ids, flat])
        self.waiting, self.numbers, self.made, self.made_of, self.parts = [], [], [], [], []

    def _gathered(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after the other, and where each ends."""
        n = self.size[pieces]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[pieces] - (ends - n), n) + np.arange(total)], ends

    def _numbers(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the pieces of all texts, one after the other, and how many each text has.

        Equal pieces meet in Arrow first, so that each is looked up once.
        """
        odd = {i: _BETWEEN.split(text) for i, text in enumerate(texts) if _is_odd(text)}
        lists = pc.split_pattern(pa.array([t for i, t in enumerate(texts) if i not in odd], pa.string()), " ")
        found = lists.flatten().dictionary_encode()
        # No piece holds a blank here, and one text is split faster than many are made.
        distinct = found.dictionary
        whole = pa.ListArray.from_arrays([0, len(distinct)], distinct)
        pieces = pc.binary_join(whole, " ")[0].as_py().split(" ") if len(distinct) else []
        numbers = np.fromiter(map(self.later.__getitem__, pieces), np.int64, len(pieces))[found.indices.to_numpy()]
        starts = lists.offsets.to_numpy()
        numbers[starts[:-1]] = [self.first[pieces[i]] for i in found.indices.to_numpy()[starts[:-1]].tolist()]
        if not odd:
            return numbers, np.diff(starts)
        plain = iter(np.split(numbers, starts[1:-1]))
        own = [self._numbers_of(odd[i]) if i in odd else next(plain) for i in range(len(texts))]
        return np.concatenate(own), np.array([len(x) for x in own])

    def _numbers_of(self, pieces: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.later.__getitem__, pieces), np.int64, len(pieces))
        numbers[0] = self.first[pieces[0]]
        return numbers

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        numbers, n = self._numbers(texts)
        self._encode_waiting()
        gathered = [self._gathered(numbers[k : k + GATHERED]) for k in range(0, len(numbers), GATHERED)]
        flat = np.concatenate([ids for ids, _ in gathered])
        total = np.cumsum(self.size[numbers])[np.cumsum(n) - 1]
        if self.pieces > CACHED_PIECES or self.held > CACHED_BYTES:
            self._forget()
        return flat, np.diff(total, prepend=0)

    def _forget(self) -> None:
        """Keep the pieces that were met first, which are the frequent ones, in half of the room."""
        kept = min(self.pieces, CACHED_PIECES // 2)
        ids, _ = self._gathered(np.arange(kept))
        held = int(self.bytes[ids].sum())
        if held > CACHED_BYTES // 2:
            self.clear()
            return
        for pieces in (self.first, self.later):
            own = {piece: number for piece, number in pieces.items() if number < kept}
            pieces.clear()
            pieces.update(own)
        self.size = self.size[:kept].copy()
        self.start, self.ids, self.pieces, self.held = np.cumsum(self.size) - self.size, ids, kept, held


def steps(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``STEP`` characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= STEP or i + 1 == len(texts):
            yield start, i + 1
            start, size = i + 1, 0


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The task's encoder of this file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
