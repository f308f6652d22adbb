"""Token ids of whole texts, as little-endian arrays of bytes.

BPE with word ends drops white space and never merges across it, so a text is
the concatenation of its words' ids. Each worker remembers words it has met, in
two generations of bounded size, and gives new ones to the library in one call.
Tokenizers of any other kind encode whole texts.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

WORDS_REMEMBERED = 400_000
# ASCII punctuation that may end a word; the apostrophe starts
# contractions and the angle bracket and bar occur in names of special tokens.
TAIL = b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'
WORDS_PER_CALL = 2000
GROUP_BYTES = 12_000_000  # of texts encoded together


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``encode(texts)`` gives the ids of an array of texts, as ``dtype``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.size = size = self._tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        # Ids that end a pre-token, if the vocabulary marks word ends in lower case.
        suffix = config["model"].get("end_of_word_suffix")
        self._ends = None
        if suffix and '"Lowercase"' in json.dumps(config["normalizer"]):
            self._ends = np.zeros(size, bool)
            for token, number in self._tokenizer.get_vocab().items():
                self._ends[number] = token.endswith(suffix)
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin, and the last end."""
        texts = _strings(texts)
        if self._ends is None:
            decoded = [(t or b"").decode("utf-8", "replace") for t in _bytes(texts).to_pylist()]
            found = self._tokenizer.encode_batch(decoded, add_special_tokens=False)
            ids = [np.array(e.ids, self.dtype) for e in found]
            sizes = [len(x) for x in ids]
            return np.concatenate([*ids, np.zeros(0, self.dtype)]), np.cumsum([0, *sizes])
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        distinct = words.flatten().dictionary_encode()
        # Each word of the texts copies its ids.
        copied = self._word_ids(distinct.dictionary).take(distinct.indices)
        first = words.offsets.to_numpy() - words.offsets[0].as_py()
        return copied.values.to_numpy(), copied.offsets.to_numpy()[first]

    def encode_ids(self, texts: list[bytes | None]) -> list[list[int]]:
        ids, at = self.encode(pa.array(texts, pa.binary()))
        return [ids[a:b].tolist() for a, b in zip(at, at[1:])]

    def _word_ids(self, words: pa.StringArray) -> pa.ListArray:
        """Ids of distinct words.

        A word of letters and closing punctuation is the ids of the letters, in lower
        case, and those of the punctuation; any other word is encoded as it is.
        """
        cores = pc.ascii_rtrim(words, characters=TAIL.decode())
        cores = pc.ascii_lower(cores).dictionary_encode()
        of_core = cores.indices.to_numpy()
        letters = pc.ascii_is_alpha(cores.dictionary).to_numpy(zero_copy_only=False).copy()
        unsure = np.flatnonzero(~letters)
        letters[unsure] = [_letters(c) for c in _bytes(cores.dictionary.take(unsure)).to_pylist()]
        split = letters[of_core]
        core_sizes = pc.binary_length(cores.dictionary).to_numpy()[of_core]
        tailed = np.flatnonzero(split & (pc.binary_length(words).to_numpy() > core_sizes))
        tails = zip(_bytes(words.take(tailed)).to_pylist(), core_sizes[tailed].tolist())
        tails = pa.array([word[size:] for word, size in tails], pa.binary()).dictionary_encode()
        parts = _bytes(cores.dictionary.filter(letters)).to_pylist()
        others = tails.dictionary.to_pylist() + _bytes(words.filter(~split)).to_pylist()
        known = [*self._part_ids(parts, others), b""]
        # Numbers of a word's two parts; the last part of all is empty.
        first = np.empty(len(words), np.int64)
        first[split] = (np.cumsum(letters) - 1)[of_core[split]]
        first[~split] = len(parts) + len(tails.dictionary) + np.arange(int((~split).sum()))
        second = np.full(len(words), len(known) - 1)
        second[tailed] = len(parts) + tails.indices.to_numpy()
        sizes = np.fromiter(map(len, known), np.int32, len(known)) // self.dtype.itemsize
        flat = pa.array(np.frombuffer(b"".join(known), self.dtype))
        ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), flat)
        both = ids.take(pa.array(np.stack([first, second], axis=1).ravel()))
        return pa.ListArray.from_arrays(pa.array(both.offsets.to_numpy()[::2]), both.values)

    def _part_ids(self, letters: list[bytes], others: list[bytes]) -> list[bytes]:
        if len(self._new) > WORDS_REMEMBERED:
            self._old, self._new = self._new, {}
        known, old = self._new, self._old
        for parts, learn in ((letters, self._learn_joined), (others, self._learn_each)):
            unknown = []
            for part in parts:
                if part not in known:
                    if part in old:
                        known[part] = old[part]
                    else:
                        unknown.append(part)
            for start in range(0, len(unknown), WORDS_PER_CALL):
                learn(unknown[start : start + WORDS_PER_CALL])
        return [*map(known.__getitem__, letters), *map(known.__getitem__, others)]

    def _learn_each(self, words: list[bytes]) -> None:
        texts = [word.decode("utf-8", "replace") for word in words]
        found = self._tokenizer.encode_batch(texts, add_special_tokens=False)
        for word, encoding in zip(words, found):
            self._new[word] = np.array(encoding.ids, self.dtype).tobytes()

    def _learn_joined(self, words: list[bytes]) -> None:
        """Words of letters in one call: each should be one pre-token."""
        joined = b" ".join(words).decode("utf-8", "replace")
        ids = np.array(self._tokenizer.encode(joined, add_special_tokens=False).ids, self.dtype)
        stops = (np.flatnonzero(self._ends[ids]) + 1) * self.dtype.itemsize
        if len(stops) != len(words):
            return self._learn_each(words)
        known, data, start = self._new, ids.tobytes(), 0
        for word, stop in zip(words, stops.tolist()):
            known[word] = data[start:stop]
            start = stop


def _letters(core: bytes) -> bool:
    """Letters that the vocabulary's normalizer (NFC, then lower case) leaves letters.

    Some turn into a letter and a mark there, which is one pre-token with punctuation
    behind it. Capital sigma is left out: it has two small forms, chosen by its neighbours.
    """
    letters = core.decode("utf-8", "replace")
    if "\u03a3" in letters or not letters.isalpha():
        return False
    return unicodedata.normalize("NFC", letters).lower().isalpha()


def _strings(texts: pa.Array) -> pa.Array:
    """Bytes taken for UTF-8 without a look at them: splitting at ASCII is safe on any."""
    return pc.cast(texts, options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))


def _bytes(strings: pa.Array) -> pa.Array:
    return strings.cast(pa.binary())


def text_groups(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with some ``GROUP_BYTES`` of text, or a single longer one."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    part = (np.cumsum(sizes) - 1) // GROUP_BYTES
    starts = np.flatnonzero(np.diff(part, prepend=-2))
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def token_blocks(
    batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int | None, block_tokens: int
) -> Iterator[list[tuple]]:
    """Blocks of consecutive ``(key, ids)`` with about ``block_tokens`` ids each.

    Batches have a key and a UTF-8 text. A document is never split between blocks.
    """
    tokens = encoder(tokenizer)
    end = np.array([] if end_id is None else [end_id], "<u4")
    block: list[tuple] = []
    held = 0
    for batch in batches:
        for part in text_groups(batch, 1):
            found, at = tokens.encode(part.column(1))
            for i, key in enumerate(part.column(0).to_pylist()):
                ids = np.concatenate([found[at[i] : at[i + 1]].astype("<u4"), end])
                block.append((key, ids))
                held += len(ids)
                if held >= block_tokens:
                    yield block
                    block, held = [], 0
    if block:
        yield block


@cache
def encoder(path: str) -> Encoder:
    """One per worker process, kept between tasks."""
    return Encoder(path)
