"""Token ids of whole texts, by the vocabulary files of public tokenizers.

Both tokenizers are given by the path of their file, which must exist on every
worker. A worker loads a file once.
"""

from __future__ import annotations

import base64
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

# Fixed values of the published vocabularies.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"""
# The same for lower-case ASCII text.
ASCII_WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"""
WORD_END = "</w>"

_loaded: dict[str, object] = {}


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_encoder(path: str) -> ByteEncoder:
    if path not in _loaded:
        _loaded[path] = ByteEncoder(path)
    return _loaded[path]


def word_encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


class ByteEncoder:
    """Byte-level BPE from a file of ranks; decoding gives back the text's bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.free_id = len(ranks)  # the first id that no text has

    def encode(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(text, disallowed_special=())

    def decode(self, ids: np.ndarray) -> bytes:
        return self._encoding.decode_bytes(ids.tolist())


class WordEncoder:
    """BPE with word ends, equal to `tokenizers` on the same file, chunk by chunk.

    White space separates words, so a text's ids are its chunks' ids in order.
    Each different chunk of the given texts is merged once, and the texts' ids
    are gathered from theirs. Chunks of plain letters and signs go together
    through the same merges in one call: after each word an upper-case letter,
    which normalised text cannot hold, stands for the word's end. All other
    chunks (special tokens, further scripts, very long ones) and texts with
    control characters that only `str.split` takes as white space go to the
    `tokenizers` library itself.
    """

    # So many chunks are merged together, which bounds the arrays of a very long text.
    TOGETHER = 1 << 21
    # So many chunks are held as strings; the others as places in tables of the different ones.
    LISTED = 1 << 15
    LONGEST = 64
    _END = "Z"
    _SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")

    def __init__(self, path: str):
        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        plain = _plain_bytes()
        special = set(self._whole.get_added_tokens_decoder())
        ranks = {}
        for token, rank in model["vocab"].items():
            if rank in special:
                continue
            end = token.endswith(WORD_END)
            word = bytes(plain[c] for c in (token[: -len(WORD_END)] if end else token))
            ranks[word + (self._END.encode() if end else b"")] = rank
        # Whether an id ends a word.
        self._ends = np.zeros(max(ranks.values()) + 1, bool)
        self._ends[[rank for word, rank in ranks.items() if word.endswith(self._END.encode())]] = True
        self._break = ranks[b" " + self._END.encode()]
        self._merges = tiktoken.Encoding(
            "words",
            pat_str=f"[^{self._END}]*{self._END}",
            mergeable_ranks=ranks,
            special_tokens={},
        )
        self._words = regex.compile(WORD_PATTERN + "| ")
        self._ascii_words = re.compile(ASCII_WORD_PATTERN + "| ")
        self._odd = re.compile(r"[^\x00-ɏ]|<\|")

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        counts: list[int] = []
        library: dict[int, np.ndarray] = {}
        ids, sizes, runs, listed = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], [], 0
        for run in self._runs(texts, counts, library):
            if runs and listed + len(run) > self.TOGETHER:
                self._gather(runs, ids, sizes)
                runs, listed = [], 0
            runs.append(run)
            listed += len(run)
        if runs:
            self._gather(runs, ids, sizes)
        every = np.concatenate(ids)
        places = np.cumsum(np.concatenate(sizes), dtype=np.int64)[np.cumsum([0, *counts])].tolist()
        return [
            library[n] if n in library else every[start:stop]
            for n, (start, stop) in enumerate(zip(places, places[1:]))
        ]

    def _runs(
        self, texts: Iterable[str], counts: list[int], library: dict[int, np.ndarray]
    ) -> Iterator[pa.DictionaryArray]:
        """The texts' chunks in runs; adds how many each text has, or its ids by the library."""
        most = min(self.LISTED, self.TOGETHER)
        chunks: list[str] = []

        def listed() -> Iterator[pa.DictionaryArray]:
            for at in range(0, len(chunks), most):
                yield pa.array(chunks[at : at + most], pa.string()).dictionary_encode()
            chunks.clear()

        for n, text in enumerate(texts):
            if any(c in text for c in self._SEPARATORS):
                found = self._whole.encode(text, add_special_tokens=False).ids
                library[n] = np.array(found, np.uint32)
                counts.append(0)
                continue
            own = text.split()
            counts.append(len(own))
            chunks += own
            if len(chunks) >= most:
                yield from listed()
        yield from listed()

    def _gather(
        self, runs: list[pa.DictionaryArray], ids: list[np.ndarray], sizes: list[np.ndarray]
    ) -> None:
        """Add the ids of the runs' chunks, and how many each chunk has; different ones are merged once."""
        runs = pa.chunked_array(runs).unify_dictionaries().chunks
        different = runs[0].dictionary.to_numpy(zero_copy_only=False).tolist()
        merged, starts, stops = self._merged(different)
        for run in runs:
            which = run.indices.to_numpy()
            size = (stops - starts)[which]
            behind = np.cumsum(size)
            # Where each id comes from: its chunk's start and its place in the chunk.
            places = np.repeat(starts[which] - (behind - size), size)
            places += np.arange(len(places))
            ids.append(merged[places])
            sizes.append(size.astype(np.int32))

    def _merged(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different chunks, and where those of each chunk start and stop."""
        odd = np.zeros(len(chunks), bool)
        if self._odd.search(" ".join(chunks)) or max(map(len, chunks), default=0) > self.LONGEST:
            odd[:] = [len(c) > self.LONGEST or self._odd.search(c) is not None for c in chunks]
        usual, other = np.flatnonzero(~odd), np.flatnonzero(odd)
        # No chunk holds a space, so the folded text comes apart into the same chunks.
        text = " ".join(compress(chunks, ~odd))
        folded = unicodedata.normalize("NFC", text).lower().split(" ") if text else []
        letters = np.array(list(map(str.isalpha, folded)), bool)
        ascii = np.array(list(map(str.isascii, folded)), bool)
        starts, stops, ids = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64), []
        for own, part, merge in [
            (usual[letters], compress(folded, letters), self._words_ids),
            (usual[~letters & ascii], compress(folded, ~letters & ascii), self._ascii_ids),
            (usual[~letters & ~ascii], compress(folded, ~letters & ~ascii), self._signs_ids),
            (other, compress(chunks, odd), self._library_ids),
        ]:
            if len(own):
                new, ends = merge(list(part))
                before = sum(map(len, ids))
                starts[own] = before + np.concatenate([[0], ends[:-1]])
                stops[own] = before + ends
                ids.append(new)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), starts, stops

    def _words_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that are one word each, and where each ends."""
        text = self._END.join(words) + self._END
        ids = self._merges.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
        return ids, np.flatnonzero(self._ends[ids]) + 1

    def _ascii_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._parted_ids(chunks, self._ascii_words)

    def _signs_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._parted_ids(chunks, self._words)

    def _parted_ids(self, chunks: list[str], pattern) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks that the pattern takes apart into words."""
        # A space between chunks becomes a word of its own, with an id that no text has.
        ids, _ = self._words_ids(pattern.findall(" ".join(chunks)))
        breaks = np.flatnonzero(ids == self._break)
        ends = np.append(breaks - np.arange(len(breaks)), len(ids) - len(breaks))
        return ids[ids != self._break], ends

    def _library_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._whole.encode_batch(chunks, add_special_tokens=False)
        ends = np.cumsum([len(f.ids) for f in found])
        return np.array(list(chain.from_iterable(f.ids for f in found)), np.uint32), ends


def _plain_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves; the other bytes, in
    order, are the characters from code point 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
