"""Token ids of whole texts with a public tokenizer file, each distinct piece encoded once.

The tokenizer file used here lower-cases, drops white space, and splits text
into pieces (runs of letters, single digits, runs of other marks) before its
merges, so a text's ids are the ids of its pieces in order.  ``encode_slice``
finds the pieces of many texts at once on their bytes, encodes each distinct
piece with the ``tokenizers`` library and gathers the ids.  A word with an
apostrophe, ``<`` or any character beyond Latin-1 letters goes through the
library's whole chain instead.  ``tests/llm`` compares the result with encoding
whole texts.
"""

from __future__ import annotations

from array import array

import numpy as np

from .common import LOWER, SPACES, byte_slices, string_hash

#: slots of the piece memo, and ids it may hold before it is emptied (bound its memory)
MEMO_BITS, MEMO_IDS = 21, 8_000_000
#: bytes of text that are taken apart at once
BLOCK_BYTES = 1 << 17

_LATIN = [chr(c) for c in (*range(97, 123), *(c for c in range(0xDF, 0x100) if c != 0xF7))]
_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[SPACES] = _SPACE
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x61:0x7B] = _LETTER
_CLASS[0x80:] = _ODD
_CLASS[[0x27, 0x3C]] = _ODD
_LOWER_TABLE, _CLASS_TABLE = LOWER.tobytes(), _CLASS.tobytes()


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    def __init__(self, path: str | None = None):
        import json

        from tokenizers import Tokenizer
        path = path or default_tokenizer()
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # pieces may be encoded one by one only if white space separates them and is dropped
        pre = spec.get("pre_tokenizer") or {}
        first = pre.get("pretokenizers", [pre])[0]
        pattern = (first.get("pattern") or {}).get("Regex", "")
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_piece = (first.get("type"), first.get("behavior")) == ("Split", "Removed") and pattern.endswith(
            "[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+") and steps == ["NFC", "Replace", "Lowercase"]
        self.bytes_of = str.maketrans({c: self.whole.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _LATIN}
                                      if self.by_piece else {})
        self._empty_memo()

    def _empty_memo(self) -> None:
        self.key = np.zeros(1 << MEMO_BITS, np.uint64)
        self.at = np.zeros(1 << MEMO_BITS, np.int32)
        self.n = np.zeros(1 << MEMO_BITS, np.int32)
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0

    def library(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _remember(self, pieces: list[str], letters: list[bool], slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        tokenize, table, out, n = self.whole.model.tokenize, self.bytes_of, array("I"), []
        for piece, plain in zip(pieces, letters):
            if plain:
                ids = [t.id for t in tokenize(piece if piece.isascii() else piece.translate(table))]
            else:
                ids = self.library(piece)
            out.extend(ids)
            n.append(len(ids))
        new = np.frombuffer(out, np.uint32) if out else np.zeros(0, np.uint32)
        if self.used + len(new) > len(self.ids):
            grown = np.zeros(max(2 * len(self.ids), self.used + len(new)), np.uint32)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        self.ids[self.used:self.used + len(new)] = new
        n = np.array(n, np.int32)
        # with equal slots the last one stays, with all of its fields
        self.key[slots], self.at[slots], self.n[slots] = keys, self.used + np.cumsum(n) - n, n
        self.used += len(new)
        return n.astype(np.int64)

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the bounds of each text among them."""
        if not self.by_piece:
            texts = [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:])]
            each = [e.ids for e in self.whole.encode_batch(texts, add_special_tokens=False)]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
            return np.fromiter((x for e in each for x in e), np.uint32, int(bounds[-1])), bounds
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.used > MEMO_IDS:
            self._empty_memo()
        # bytes.translate maps bytes without an index array of eight times their size
        low = np.frombuffer(bytearray(data.tobytes().translate(_LOWER_TABLE)), np.uint8)
        kind = np.frombuffer(bytearray(low.tobytes().translate(_CLASS_TABLE)), np.uint8)
        # two-byte Latin-1 letters: C3 80-BF but for the signs at 97 and B7; 80-9E are capitals
        lead = np.flatnonzero(low[:-1] == 0xC3)
        second = low[lead + 1]
        letter = (second >= 0x80) & (second != 0x97) & (second != 0xB7)
        lead, second = lead[letter], second[letter]
        kind[lead] = kind[lead + 1] = _LETTER
        low[lead + 1] = np.where(second < 0x9F, second + 0x20, second)
        # pieces: a new one at each change of kind, each digit and each text
        n = len(low)
        cut = np.empty(n, bool)
        cut[0] = True
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut |= kind == _DIGIT
        cut[offsets[(offsets > 0) & (offsets < n)]] = True
        odd = np.flatnonzero(kind == _ODD)
        whole = np.zeros(0, np.int64)
        if len(odd):                                 # a word with an odd character is one piece of its own
            space = kind == _SPACE
            first = np.empty(n, bool)
            first[0] = True
            first[1:] = space[:-1]
            first[offsets[(offsets > 0) & (offsets < n)]] = True
            words = np.flatnonzero(first & ~space)
            ends = np.append(words[1:], n)
            w = np.unique(np.searchsorted(words, odd, "right") - 1)
            for a, b in zip(words[w].tolist(), ends[w].tolist()):
                stop = a + int(np.argmax(space[a:b])) if space[a:b].any() else b
                cut[a + 1:stop] = False
                if stop < n:
                    cut[stop] = True
                low[a:stop] = data[a:stop]
            whole = words[w]
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        keep = kind[starts] != _SPACE
        if len(whole):
            odd_piece = np.zeros(len(starts), bool)
            odd_piece[np.searchsorted(starts, whole)] = True
            keep |= odd_piece
            odd_piece = odd_piece[keep]
        starts, ends = starts[keep], ends[keep]
        key = string_hash(low, starts, ends)
        if len(whole):                               # kept apart from plain pieces of the same bytes
            key[odd_piece] ^= np.uint64(0xA5A5A5A5A5A5A5A5)
        slots = (key >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        at, n_ids = self.at[slots].astype(np.int64), self.n[slots].astype(np.int64)
        todo = np.flatnonzero(self.key[slots] != key)
        if len(todo):
            value, some, inverse = np.unique(key[todo], return_index=True, return_inverse=True)
            some = todo[some]
            raw = low.tobytes()
            pieces = [raw[i:j].decode() for i, j in zip(starts[some].tolist(), ends[some].tolist())]
            plain = kind[starts[some]] == _LETTER
            if len(whole):
                plain &= ~odd_piece[some]
            before = self.used
            n_new = self._remember(pieces, plain.tolist(), slots[some], value)
            at[todo], n_ids[todo] = (before + np.cumsum(n_new) - n_new)[inverse], n_new[inverse]
        total = np.concatenate([[0], np.cumsum(n_ids)])
        ids = self.ids[np.repeat(at - total[:-1], n_ids) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offsets)]

    def encode_blocks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode_slice`` of runs of whole texts of about ``BLOCK_BYTES``, whose arrays stay in the processor's cache."""
        ids, bounds, i, n = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], 0, len(offsets) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, "right")) - 1)
            of, at = self.encode_slice(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            ids.append(of)
            bounds.append(at[1:] + bounds[-1][-1])
            i = j
        return np.concatenate(ids), np.concatenate(bounds)

    def encode(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return self.encode_slice(raw, np.array([0, len(raw)]))[0]


def encoded_texts(enc: Encoder, texts, end_id: int):
    """``(first row, ids, bounds)`` per slice of a text column; each text is followed by ``end_id``."""
    for i, _, data, offsets in byte_slices(texts):
        ids, bounds = enc.encode_blocks(data, offsets)
        ids = np.insert(ids, bounds[1:], np.uint32(end_id)).astype("<u4")
        yield i, ids, bounds + np.arange(len(bounds))


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
