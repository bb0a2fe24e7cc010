"""Whole-text token ids with a public tokenizer, one Arrow batch at a time.

BPE never merges across pre-tokens, so the ids of a text are those of its
pre-tokens in order.  Texts in plain Latin characters are cut here by the
vocabulary's own rule, and each distinct pre-token is encoded once by the
tokenizers library and kept in a bounded table; any other text goes to the
library whole.  Many texts of Latin-1 characters are cut together, as one array
of character classes, and Arrow finds the distinct pre-tokens; further plain
characters take the same rule as a pattern.  Tests compare all with the library
on whole texts.
"""

from __future__ import annotations

import contextlib
import functools
import itertools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa

CACHE_PIECES = 330_000
BATCH_PIECES = 1024
TOGETHER = 1 << 21  # characters of texts cut together; a longer text is alone

# Characters on whose class Python and the library agree: ASCII, Latin letters, common signs.
_OTHER = re.compile("[^\t\n\x0b\x0c\r\x20-\x7e¡-©«¬®-±´¶-¸»¿-ɏ‐-‧€]")


@functools.cache
def _plain() -> list[str]:
    """The plain characters, also lower-cased (some of these lie beyond)."""
    plain = [c for c in map(chr, range(0x2100)) if not _OTHER.search(c)]
    return sorted({*plain, *"".join(plain).lower()})


@functools.cache
def splits() -> dict[str, str]:
    """The pre-token rules of the two vocabularies for plain characters, also lower-cased, which are listed by class."""
    plain = _plain()
    letters, digits, signs = ("".join(re.escape(c) for c in plain if re.fullmatch(kind, c)) for kind in (r"[^\W\d_]", r"\d", r"[^\s\w]|_"))
    return {"word": rf"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{digits}]|[{signs}]+",
            "byte": rf" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{digits}]+| ?[{signs}]+|\s+(?!\S)|\s+"}


# Character classes of the cut.
_SPACE, _LETTER, _DIGIT, _SIGN, _ELSE = 1, 2, 3, 4, 5
_TAILS = {1: {b"s", b"t", b"m", b"d"}, 2: {b"re", b"ve", b"ll"}}


@functools.cache
def _classes(folds: bool) -> tuple[bytes, bytes]:
    """Translation tables of Latin-1 bytes: what the vocabulary reads, and its class; 0 ends a text."""
    lower, kinds = bytearray(range(256)), bytearray([_ELSE]) * 256
    for b in range(1, 256):
        c = chr(b)
        if not _OTHER.search(c):
            kinds[b] = (_SPACE if c.isspace() else _LETTER if re.fullmatch(r"[^\W\d_]", c) else _DIGIT if re.fullmatch(r"\d", c) else _SIGN)
            lower[b] = ord(c.lower() if folds else c)
    kinds[0] = 0
    return bytes(lower), bytes(kinds)


def _starts(raw: bytes, kinds: bytes, folds: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where a pre-token, or the end of a text, begins; and the class of every character.  ``raw`` ends every text with a 0."""
    kind = np.frombuffer(raw.translate(kinds), np.uint8)
    start = np.empty(len(kind), bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == 0
    if folds:  # each digit is one; white space is none
        start |= kind == _DIGIT
        blank = None
    else:  # a blank goes with what follows, the rest of a white-space run stands before it
        blank = np.frombuffer(raw, np.uint8) == 32
        follows = (kind[:-1] == _SPACE) & (kind[1:] > _SPACE)
        start[:-1] |= follows
        start[1:] &= ~(follows & blank[:-1])
    a = raw.find(b"'")
    while a >= 0:  # 's, 't and so on, where no sign and no blank before the mark takes it
        if (a == 0 or kind[a - 1] != _SIGN) and (folds or a == 0 or not blank[a - 1]):
            for n in (1, 2):
                if raw[a + 1:a + 1 + n] in _TAILS[n]:
                    start[a + 1:a + 1 + n] = False
                    start[a + 1 + n] = True
                    break
        a = raw.find(b"'", a + 1)
    return start, kind


@functools.cache
def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: visible bytes stand for themselves, the rest for letters from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """ids of whole texts; ``path`` is a tokenizers JSON file of one of the two kinds."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.path = path
        self.folds = parts["normalizer"] is not None
        self.split = re.compile(splits()["word" if self.folds else "byte"]).findall
        # the same merges, for pre-tokens set apart by blanks
        parts |= {"normalizer": None, "added_tokens": [], "post_processor": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.merges = Tokenizer.from_str(json.dumps(parts))
        self.letters = str.maketrans({c: "".join(_byte_letters()[b] for b in c.encode()) for c in _plain()})
        self.cache_pieces = cache_pieces
        self.lower, self.kinds = _classes(self.folds)
        self.plain = bytes(b for b, k in enumerate(self.kinds) if 0 < k < _ELSE)
        # the table: a number for each pre-token, and by number its ids' place and count, and how often it was asked for
        self.known: dict[bytes | str, int] = {}
        self.ids, self.sizes, self.uses = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)

    @functools.cached_property
    def library(self):
        """The whole tokenizer, loaded for the first text that is cut by it."""
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def _cut(self, text: str) -> list[str] | None:
        """Pre-tokens, or None for a text that the library has to cut."""
        if "<|" in text or _OTHER.search(text):
            return None
        if self.folds and not text.isascii() and ("İ" in text or not unicodedata.is_normalized("NFC", text)):
            return None
        return self.split(text.lower() if self.folds else text)

    def _learn(self, new: list[bytes | str]) -> None:
        ids, sizes = [self.ids], [self.sizes]
        for lo in range(0, len(new), BATCH_PIECES):
            part = [p if isinstance(p, str) else p.decode("latin-1") for p in new[lo:lo + BATCH_PIECES]]
            joined = " ".join([p if p.isalpha() and p.isascii() else p.translate(self.letters) for p in part])
            e = self.merges.encode(joined, add_special_tokens=False)
            ids.append(np.array(e.ids, "<u4"))
            sizes.append(np.bincount(e.word_ids, minlength=len(part)))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.uses = np.append(self.uses, np.zeros(len(new), np.int64))
        self.begins = np.cumsum(self.sizes) - self.sizes

    def _forget(self) -> None:
        """Leaves the half of the table asked for most; the newer ones among equals."""
        keep = np.sort(np.argsort(self.uses, kind="stable")[-(self.cache_pieces // 2):])
        pieces = list(self.known)
        self.known = {pieces[i]: k for k, i in enumerate(keep.tolist())}
        self.ids, self.sizes, self.uses = self._ids(keep), self.sizes[keep], self.uses[keep] // 2
        self.begins = np.cumsum(self.sizes) - self.sizes

    def _numbers(self, pieces: list[bytes | str]) -> np.ndarray:
        """The number of each of the distinct ``pieces`` in the table, which learns the new ones."""
        if len(self.known) > self.cache_pieces:
            self._forget()
        out = np.fromiter(map(self.known.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn([pieces[i] for i in new.tolist()])
        self.uses[out] += 1
        return out

    def _ids(self, numbers: np.ndarray) -> np.ndarray:
        sizes = self.sizes[numbers]
        take = np.repeat(self.begins[numbers] - (np.cumsum(sizes) - sizes), sizes)
        take += np.arange(len(take))
        return self.ids[take]

    def _together(self, raws: list[bytes]) -> list[bytes]:
        """ids of Latin-1 texts without a 0 in them, by one cut of all."""
        raw = b"\0".join([*raws, b""]).translate(self.lower)
        start, kind = _starts(raw, self.kinds, self.folds)
        firsts = np.cumsum([0] + [len(r) + 1 for r in raws])
        inside = kind > (_SPACE if self.folds else 0)
        before = np.append(np.flatnonzero(start & inside), len(raw))
        at = np.searchsorted(before, firsts)  # first pre-token of each text
        chars = np.frombuffer(raw, np.uint8)[inside]
        edges = np.append(np.flatnonzero(start[inside]), len(chars)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(chars)]).dictionary_encode()
        numbers = self._numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
        cuts = (4 * np.append(0, np.cumsum(self.sizes[numbers]))[at]).tolist()
        ids = self._ids(numbers).tobytes()
        return [ids[a:z] for a, z in itertools.pairwise(cuts)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (null: none)."""
        out: list[bytes] = [b""] * len(texts)
        waiting, size = [], 0

        def put():
            for (i, _), ids in zip(waiting, self._together([r for _, r in waiting]), strict=True):
                out[i] = ids
            waiting.clear()

        for i, t in enumerate(texts):
            if not t:
                continue
            raw = None
            if "<|" not in t:
                with contextlib.suppress(UnicodeEncodeError):
                    raw = t.encode("latin-1")
            if raw is not None and not raw.translate(None, self.plain):
                if waiting and size + len(raw) > TOGETHER:
                    put()
                    size = 0
                waiting.append((i, raw))
                size += len(raw)
            elif (p := self._cut(t)) is not None:
                own = list(dict.fromkeys(p))
                at = dict(zip(own, self._numbers(own).tolist(), strict=True))
                out[i] = self._ids(np.fromiter(map(at.__getitem__, p), np.int64, len(p))).tobytes()
            else:
                out[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        if waiting:
            put()
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file, kept between tasks."""
    return Encoder(path)


def give_back(encoders: bool = False) -> None:
    """Workers live on: return what Arrow holds unused and, for tasks that follow the encoding ones, the encoders."""
    if encoders:
        encoder.cache_clear()
    pa.default_memory_pool().release_unused()
