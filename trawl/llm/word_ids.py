"""Token ids of whole texts, word by word and many texts at once.

Most words of a corpus are repeats. A batch of texts is cut at ASCII white
space by Arrow, its distinct words are looked up in a worker's cache, and the
ids of all places are gathered with numpy, so Python handles a word once a batch
and not once a place. This is right only for files whose normaliser and
pre-tokenizer never join characters across ASCII white space; the file's own
settings are compared with the known ones, and any other file has its texts
encoded whole.

A text is any length; a batch is taken in slices of ``SLICE_BYTES`` (at least
one text), so memory follows the longest text, not the batch. A null text is
an empty one. Special tokens' strings in a text are handled as the file says.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries kept in a worker's word cache unless the caller has memory for more; beyond that the cache begins anew.
CACHED_WORDS = 100_000
# Words longer than this are encoded each time.
CACHED_LENGTH = 64
SLICE_BYTES = 8 << 20

# The settings of word_bpe_49k.json, under which words are independent.
WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]

# Characters that NFC leaves alone and whose lower case is one letter.
_PLAIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
# WORD_SPLIT over those characters (ª, º, µ, ², ³, ¹, ¼-¾ aren't among them).
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ \t\n\r\x0b\x0c]+")


def byte_characters() -> dict[int, int]:
    """Byte-level BPE files write a byte as a printable character: itself where that is printable, else from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(rest)}


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``texts`` in runs of at most ``most`` bytes, or one text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, ends = 0, np.cumsum(sizes, dtype=np.int64)
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(at, to - at)
        at = to


def _packed(ids: list[int]) -> bytes:
    """Ids as 4 bytes each, in the machine's order."""
    return array("I", ids).tobytes()


class WordIds:
    """Ids by a ``tokenizers`` file without special tokens; words through a cache where the file allows it."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            (spec.get("normalizer") or {}).get("normalizers") == NORMALIZERS
            and steps[0].get("pattern") == {"Regex": WORD_SPLIT}
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and not steps[1].get("use_regex")
            and not steps[1].get("add_prefix_space")
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        )
        self.cached_words = cached_words
        self.model = self.tokenizer.model
        self.byte_chars = byte_characters()
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        plain = part.isascii() and part.isprintable()
        shown = part if plain else part.encode().decode("latin-1").translate(self.byte_chars)
        out = _packed([t.id for t in self.model.tokenize(shown)])
        if len(self.parts) >= self.cached_words:
            self.parts.clear()
        if len(part) <= CACHED_LENGTH:
            self.parts[part] = out
        return out

    def _word(self, word: str) -> bytes:
        if (word.isascii() or _PLAIN.fullmatch(word)) and "<|" not in word:
            known, new = self.parts.get, self._part
            out = b"".join([known(p) or new(p) for p in _SPLIT.findall(word.lower())])
        else:
            out = _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(self.words) >= self.cached_words:
            self.words.clear()
        if len(word) <= CACHED_LENGTH:
            self.words[word] = out
        return out

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = cut.flatten().dictionary_encode()
        known, new = self.words.get, self._word
        each = [x if (x := known(w)) is not None else new(w) for w in coded.dictionary.to_numpy(zero_copy_only=False)]
        sizes = np.fromiter(map(len, each), np.int64, len(each)) >> 2
        table = np.frombuffer(b"".join(each), np.uint32)
        codes = coded.indices.to_numpy()
        n = sizes[codes]
        ends = np.cumsum(n)
        starts = np.cumsum(sizes) - sizes
        places = np.repeat(starts[codes] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
        upto = np.concatenate([[0], ends])
        words = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        return table[places], upto[words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and ``len(texts) + 1`` offsets into them."""
        texts = pc.fill_null(texts, "")
        if self.by_word:
            return self._by_word(texts)
        found = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
        return np.array([i for x in found for i in x], dtype="<u4"), offsets

    def encode_ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with ``end_id`` after each text."""
        ids, offsets = self.encode(texts)
        return np.insert(ids, offsets[1:], end_id).astype("<u4"), offsets + np.arange(len(offsets))


@lru_cache(maxsize=2)
def word_ids(path: str, cached_words: int = CACHED_WORDS) -> WordIds:
    """The one instance of a worker for ``path`` and a cache of that size."""
    return WordIds(path, cached_words)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
