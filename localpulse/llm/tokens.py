"""Token ids of whole texts, equal to what the tokenizers library gives.

The word-level BPE vocabulary never merges across the pieces its pre-tokenizer
makes, so a piece gets the same ids wherever it stands. Pieces are found and
hashed on bytes for a whole Arrow batch at once; the library encodes each
distinct piece once per worker and the ids are gathered from that table. That is
done only for files whose normaliser and pre-tokenizer are the ones it was written
for; with any other file the library encodes each text whole.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np

from localpulse.llm.core import HashTable, run_hashes

#: Pieces a worker remembers before it starts afresh; bounds its memory, not what is encoded.
REMEMBERED_PIECES = 1_000_000

_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)


def _kind(b: int) -> int:
    if b in (32, 9, 10, 11, 12, 13):
        return _SPACE
    if 65 <= b <= 90 or 97 <= b <= 122:
        return _LETTER
    if 48 <= b <= 57:
        return _DIGIT
    return _SIGN if 33 <= b <= 126 and b != 39 else _OTHER


_KIND = np.array([_kind(b) for b in range(256)], np.uint8)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_MARK = np.frombuffer(b"<|", np.uint8)


def _byte_letters() -> dict[int, int]:
    """The printable stand-ins that byte-level BPE vocabularies use for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


#: Normaliser and pre-tokenizer whose pieces ``encode`` finds by itself: fixed values.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def has_known_pieces(tokenizer: dict) -> bool:
    """Whether a tokenizer file splits texts the way ``PieceEncoder`` does."""
    steps = (tokenizer.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = len(steps) == 2 and steps[0].get("pattern") == {"Regex": _PIECES} and steps[0].get("invert") is True and steps[0].get("behavior") == "Removed"
    plain = split and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex")
    marks = all("<|" in t["content"] and not t.get("lstrip") and not t.get("rstrip") for t in tokenizer.get("added_tokens", []))
    return tokenizer.get("normalizer") == _NORMALIZER and plain and marks and tokenizer["model"].get("type") == "BPE" and not tokenizer["model"].get("dropout")


class PieceEncoder:
    """Encodes batches of texts; one per worker process."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_pieces = has_known_pieces(json.load(f))
        self.dtype = np.uint16 if self.tok.get_vocab_size(with_added_tokens=True) <= 65536 else np.uint32
        self._forget()

    def _forget(self) -> None:
        self.known = HashTable()
        self.flat = np.zeros(1 << 16, self.dtype)
        self.start = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _learn(self, hashes: np.ndarray, pieces: list[bytes], simple: list[bool]) -> None:
        tokenize, letters = self.tok.model.tokenize, _LETTERS
        ids: list[int] = []
        counts: list[int] = []
        for piece, plain in zip(pieces, simple, strict=True):
            own = [t.id for t in tokenize(piece.decode("latin-1").translate(letters))] if plain else self._whole(piece.decode("utf-8"))
            ids += own
            counts.append(len(own))
        at = self.known.add(hashes)
        while len(self.start) < self.known.size:
            self.start, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count))
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.count[at] = counts
        self.start[at] = self.used + np.cumsum(counts) - counts
        self.used += len(ids)

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after another, and how many each row has."""
        rows = len(offs) - 1
        if not len(buf):
            return np.zeros(0, self.dtype), np.zeros(rows, np.int64)
        if not self.by_pieces:
            own = [self._whole(buf[a:b].tobytes().decode("utf-8")) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            return np.array([x for ids in own for x in ids], self.dtype), np.array([len(ids) for ids in own], np.int64)
        kind = _KIND[buf]
        low = _LOWER[buf]
        # Two-byte letters from U+00C0 to U+00FF, less the signs at D7 and F7, are letters with a case rule of their own.
        lead = np.flatnonzero(buf[:-1] == 0xC3)
        tail = buf[lead + 1]
        lead = lead[(tail != 0x97) & (tail != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        upper = lead[buf[lead + 1] < 0x9F] + 1
        low[upper] += 0x20
        edge = np.ones(len(buf) + 1, bool)
        a, b = kind[:-1], kind[1:]
        edge[1:-1] = ((a != b) | (a == _DIGIT)) & (a != _OTHER) & (b != _OTHER) | (a == _SPACE) | (b == _SPACE)
        edge[offs] = True
        cut = np.flatnonzero(edge)
        starts, ends = cut[:-1], cut[1:]
        keep = kind[starts] != _SPACE
        starts, ends = starts[keep], ends[keep]
        hashes = run_hashes(low, starts, ends)
        if self.known.size > REMEMBERED_PIECES:
            self._forget()
        index = self.known.find(hashes)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            distinct, at = np.unique(hashes[missing], return_index=True)
            at = missing[at]
            odd = np.concatenate([[0], np.cumsum(kind == _OTHER)])
            simple = (odd[ends[at]] == odd[starts[at]]).tolist()
            view = low.tobytes()
            self._learn(distinct, [view[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], simple)
            index[missing] = self.known.find(hashes[missing])
        n = self.count[index]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.start[index] - total[:-1], n) + np.arange(total[-1])]
        bounds = np.searchsorted(starts, offs)
        per_row = total[bounds[1:]] - total[bounds[:-1]]
        return self._special(buf, offs, ids, per_row)

    def _special(self, buf, offs, ids, per_row):
        """Rows in which a special token's string may stand are encoded whole by the library."""
        found = np.flatnonzero((buf[:-1] == _MARK[0]) & (buf[1:] == _MARK[1]))
        if not len(found):
            return ids, per_row
        rows = np.unique(np.searchsorted(offs, found, "right") - 1)
        parts, done, total = [], 0, np.concatenate([[0], np.cumsum(per_row)])
        per_row = per_row.copy()
        for r in rows.tolist():
            text = buf[offs[r] : offs[r + 1]].tobytes().decode("utf-8")
            own = np.array(self._whole(text), self.dtype)
            parts += [ids[done : total[r]], own]
            done = total[r + 1]
            per_row[r] = len(own)
        return np.concatenate([*parts, ids[done:]]), per_row

    def encode_with_end(self, buf: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after each row's ids."""
        ids, n = self.encode(buf, offs)
        stops = np.cumsum(n)
        return np.insert(ids, stops, self.dtype(end_id)), n + 1


@functools.cache
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def slices(offs: np.ndarray, limit: int = 4 << 20) -> list[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or one row."""
    out, i, n = [], 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        out.append((i, min(j, n)))
        i = min(j, n)
    return out
