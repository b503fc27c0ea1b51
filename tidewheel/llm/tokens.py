"""Token ids of texts from a tokenizer file, with a bounded memory of pieces seen before.

A pre-tokenizer cuts a text into pieces that get the same ids wherever they stand, so a piece is
encoded once and its ids are joined as bytes afterwards. Texts of ASCII and Latin letters are cut
here and their pieces go to the library's model; runs between spaces of any other text go through
the whole library. The memory lives as long as the worker process; when it is full it is emptied,
which costs time, never a result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one thread a task

REMEMBERED = 400_000
# letters that lower-case and compose to themselves one by one, so Python's rules are the library's
_LETTERS = "a-zA-ZÀ-ÖØ-öø-įĲ-ňŊ-ſ"
_SIMPLE = re.compile(rf"[\x20-\x7e\t-\r{_LETTERS}]*")
# Fixed value: the pre-tokenizer's pattern, for such texts after lower-casing.
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\x20\t-\r{_LETTERS}0-9]+")
# how byte-level vocabularies spell bytes: printable ones as themselves, the others from U+0100 on
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SPELLED = {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}


class _Known(dict[str, bytes]):
    """Ids of pieces; those of a new one are found as it is looked up, so a text is gone through once."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.find(piece)
        return ids


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    Cuts texts itself only if the file's tokenizer gives the same ids for a set of probes; others
    are encoded text by text.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = _Known(self._piece)
        self.written = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        probes = ["Ab cd\n\tEf, (gh) 12", "it's 'tis WE'LL x''s ''", "Été straße!! | ***\x0b\x0c~", "a.b_c-d@e 3.14"]
        self.cuts = all("<|" in t.content for t in self.tokenizer.get_added_tokens_decoder().values()) and all(
            self._cut(p) == w for p, w in zip(probes, self._whole(probes), strict=True)
        )

    def _whole(self, texts: list[str]) -> list[bytes]:
        written = self.written
        return [b"".join([written[i] for i in e.ids]) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, _PIECE.findall(text.lower())))

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_SPELLED)
        written = self.written
        return b"".join([written[t.id] for t in self.model.tokenize(spelled)])

    def _runs(self, text: str) -> bytes:
        """Run by run between ASCII spaces; a run's key cannot be a piece's, which has no NUL in front."""
        runs = ["\0" + r.decode() for r in text.encode().split()]
        fresh = [r for r in dict.fromkeys(runs) if r not in self.known]
        self.known.update(zip(fresh, self._whole([r[1:] for r in fresh]), strict=True))
        return b"".join(map(self.known.__getitem__, runs))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text; NULL is the empty text."""
        if not self.cuts:
            yield from self._whole([t or "" for t in texts])
            return
        for text in texts:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            text = text or ""
            yield self._cut(text) if "<|" not in text and _SIMPLE.fullmatch(text) else self._runs(text)


@lru_cache(maxsize=2)
def shared_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a worker process."""
    return WordEncoder(path)


def slices(batches, rows: int = 256):
    """The same rows in smaller batches, so that few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
