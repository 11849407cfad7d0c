"""Token ids of whole texts with a public tokenizer, inside Spark tasks.

A text is cut before single spaces, around line ends, and where an ASCII letter
or digit meets ASCII punctuation.  Both tokenizers always end a piece there
(a space or punctuation opens the next one), so the ids of a text are those of
its pieces put together, and each distinct piece is encoded once.  Texts with
runs of white space, white space at an end, or the opening of a special token are encoded as they stand.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import flat_bytes

#: White space next to white space or at an end, or the opening of a special token.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
IRREGULAR = rf"{_WHITE}{_WHITE}|^{_WHITE}|{_WHITE}$|<\|"
_WORD = np.array([48 <= x <= 57 or 65 <= x <= 90 or 97 <= x <= 122 for x in range(256)])
_MARK = np.array([33 <= x <= 126 and not _WORD[x] for x in range(256)])
#: Byte-level tokenizers write each byte as one printable character.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_TEXT = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Pieces that were met lately stay in memory: two generations of
    ``most_kept`` at most, the older of which is dropped when the younger is full."""

    def __init__(self, path: str, most_kept: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.most_kept = Tokenizer.from_file(path), most_kept
        self.lower = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("A") == "a"
        self.model = self.tokenizer.model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, np.uint32).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, piece: str) -> bytes:
        """A piece of Latin letters, with or without a space before it, is one
        word of the model; only its bytes' characters have to be written."""
        text = piece.lower().lstrip(" ") if self.lower else piece
        text = text.replace(" ", BYTE_TEXT[32]) if text.isascii() else text.encode().decode("latin-1").translate(BYTE_TEXT)
        return array("I", [x.id for x in self.model.tokenize(text)]).tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        out: list = list(map(young.get, pieces))
        odd: list[int] = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            piece = pieces[i]
            ids = old.get(piece)
            if ids is None:
                letters = piece[1:] if piece[:1] == " " else piece
                # The lower case of U+0130 is two characters.
                if letters.isalpha() and (letters.isascii() or max(letters) < "\u0250" and "\u0130" not in letters):
                    ids = self._word(piece)
                else:
                    odd.append(i)
                    continue
            out[i] = young[piece] = ids
        for i, ids in zip(odd, self._whole([pieces[i] for i in odd]), strict=True):
            out[i] = young[pieces[i]] = ids
        if len(young) > self.most_kept:
            self.young, self.old = {}, young
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        if not len(texts):
            return []
        odd = pc.match_substring_regex(texts, IRREGULAR)
        out: list = [None] * len(texts)
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(at):
            for i, ids in zip(at.tolist(), self._whole(texts.filter(odd).to_pylist()), strict=True):
                out[i] = np.frombuffer(ids, "<u4")
        at = np.flatnonzero(~odd.to_numpy(zero_copy_only=False))
        if not len(at):
            return out
        flat, offsets = flat_bytes(texts.filter(pc.invert(odd)) if len(at) < len(texts) else texts)
        cut = np.zeros(len(flat) + 1, bool)
        cut[:-1] = flat == 32
        line = np.flatnonzero(flat == 10)
        cut[line] = cut[line + 1] = True
        cut[1:-1] |= _WORD[flat[:-1]] & _MARK[flat[1:]]
        cut[offsets] = True
        edges = np.flatnonzero(cut).astype(np.int64)
        if len(edges) < 2:
            for i in at.tolist():
                out[i] = np.zeros(0, "<u4")
            return out
        spans = pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(flat)])
        coded = spans.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        blobs = self._pieces(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(blobs), "<u4")
        many = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(many)])
        flat_ids = ids[np.repeat(starts[codes] - upto[:-1], many) + np.arange(upto[-1])]
        ends = upto[np.searchsorted(edges, offsets)]
        for i, a, b in zip(at.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[i] = flat_ids[a:b]
        return out


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """The encoder of this worker process, which serves several tasks; what it
    keeps in memory is bounded, and ids do not depend on it."""
    return Encoder(path)
