"""Token ids of whole texts with a public tokenizer, piece by piece through a bounded cache.

The tokenizer cuts a text into pieces (letters, a digit, other characters) that never cross white
space, and tokenizes each piece alone; the last token of a piece carries the word end. Texts of ASCII
and precomposed Latin-1 letters are cut here by the same pattern, and the pieces not seen before are
tokenized together in one call. Any other word goes to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np

#: Pieces, and words that went to the tokenizer whole, that one Python worker remembers; afresh beyond.
CACHE_PIECES = 1_000_000
#: Id that ends every document.
END_ID = 2
#: Characters cut at a time, at white space.
STRETCH = 1 << 20

# The pre-tokenizer's pattern on this alphabet.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
_PIECE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9à-öø-ÿ]+"
)
# The tokenizer's engine takes a sharp s after a sign for a sign: such words go to it whole.
_ODD = re.compile(r"[^\sA-Za-zÀ-ÖØ-öø-ÿ]ß")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    def __init__(self, path: str, end_id: int = END_ID, cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        # Pieces are lower case and split already.
        self._plain = Tokenizer.from_file(path)
        self._plain.normalizer = normalizers.Sequence([])
        self._plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        described = json.loads(Path(path).read_text())
        vocabulary = described["model"]["vocab"]
        suffix = described["model"]["end_of_word_suffix"]
        self._special = [t["content"] for t in described["added_tokens"]]
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._end = np.array([end_id], "<u4").tobytes()
        self._pieces: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}
        self._cache_pieces = cache_pieces

    def _learn(self, pieces: list[str]) -> None:
        for start in range(0, len(pieces), 1000):
            run = pieces[start : start + 1000]
            ids = np.array(self._plain.encode(" ".join(run), add_special_tokens=False).ids, "<u4")
            data = ids.tobytes()
            ends = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()
            begins = [0, *ends[:-1]]
            parts = [data[i:j] for i, j in zip(begins, ends)]
            self._pieces.update(zip(run, parts, strict=True))

    def _plain_ids(self, text: str) -> bytes:
        pieces = _PIECE.findall(text.lower())
        if unknown := set(pieces).difference(self._pieces):
            if len(self._pieces) + len(unknown) > self._cache_pieces:
                self._pieces, unknown = {}, set(pieces)
            self._learn(list(unknown))
        return b"".join(map(self._pieces.__getitem__, pieces))

    def _word_ids(self, word: str) -> bytes:
        found = self._words.get(word)
        if found is None:
            if len(self._words) > self._cache_pieces // 8:
                self._words = {}
            ids = self._whole.encode(word, add_special_tokens=False).ids
            found = self._words[word] = np.array(ids, "<u4").tobytes()
        return found

    def _is_plain(self, text: str) -> bool:
        if any(special in text for special in self._special):
            return False
        return bool(_PLAIN.fullmatch(text)) and not ("ß" in text and _ODD.search(text))

    def _parts(self, text: str) -> Iterator[bytes]:
        start = 0
        while start < len(text):
            end = start + STRETCH
            if end < len(text):
                at = re.compile(r"[\t-\r ]").search(text, end)
                end = at.start() if at else len(text)
            stretch = text[start:end]
            start = end
            if self._is_plain(stretch):
                yield self._plain_ids(stretch)
            else:
                for word in re.findall(r"[^\t-\r ]+", stretch):
                    yield self._plain_ids(word) if self._is_plain(word) else self._word_ids(word)

    def ids(self, text: str | None) -> bytes:
        """Ids of a whole text and the end id, as little-endian unsigned 32-bit; null is empty."""
        return b"".join([*self._parts(text or ""), self._end])


@lru_cache(maxsize=2)
def word_tokenizer(path: str, end_id: int = END_ID) -> WordTokenizer:
    """One tokenizer for each Python worker."""
    return WordTokenizer(path, end_id)
