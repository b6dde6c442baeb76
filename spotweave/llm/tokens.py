"""Token ids of whole texts by a public tokenizer file.

The tokenizer never joins what white space parts, so a text's ids are those of
its words, one after the other.  Each distinct word of a slice of texts is
encoded once, and the slice's ids are gathered from these by position.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

TOKENIZER = "word_bpe_49k.json"
SLICE_BYTES = 4 << 20  # bytes of text encoded at once; a longer text makes a slice of its own
CACHE = 600_000  # words kept; a full cache is emptied, which only costs time
LONGEST = 64  # longer words are not kept

# Latin letters lower-case one by one and have no other normal form.  A run of marks after letters is a piece of its
# own for the tokenizer, so a space may part them; an apostrophe may start a contraction, so it is no mark.
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_MARKS = re.compile(r"[!-&(-/:-@\[-`{-~]+")
_PARTED = r"([a-z\x{DF}-\x{F6}\x{F8}-\x{FF}])([!-&(-/:-@\[-`{-~]+)"
# Texts with other characters, or with what may be a special token, are left as they are.
_OTHER = r"[^\x{0}-\x{FF}]|<\|"


class WordEncoder:
    """Ids of texts; runs of Latin letters or of marks go straight to the tokenizer's model."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cache: dict[str, bytes] = {"": b""}
        # How the model writes the bytes of letters beyond ASCII.
        show = self.tokenizer.pre_tokenizer.pre_tokenize_str if self.tokenizer.pre_tokenizer else None
        letters = "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
        shown = "".join(part for part, _ in show(letters)) if show else ""
        data = letters.encode().decode("latin-1")
        self.written = str.maketrans(data, shown) if len(shown) == len(data) else {}
        # Tokenizers of another kind always take the long way.
        self.short = all(self._of_run(w) == self._whole(w) for w in ("hello", "thenon", "café", "größe", "...", "$$$"))

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _of_run(self, run: str) -> bytes:
        written = run if run.isascii() else run.encode().decode("latin-1").translate(self.written)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def word(self, word: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a word."""
        found = self.cache.get(word)
        if found is None:
            run = self.short and (_LETTERS.fullmatch(word) or _MARKS.fullmatch(word))
            found = self._of_run(word) if run else self._whole(word)
            if len(word) <= LONGEST:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                    self.cache[""] = b""
                self.cache[word] = found
        return found

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Slices of rows: (first row, ids of all its texts, where each text's ids end); null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        row = 0
        while row < len(texts):
            done = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
            yield row, *self._encoded(texts.slice(row, stop - row))
            row = stop
        pa.default_memory_pool().release_unused()  # the worker may serve other stages of an executor next

    def _encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.short:
            parted = pc.replace_substring_regex(pc.utf8_lower(texts), _PARTED, r"\1 \2")
            texts = pc.if_else(pc.match_substring_regex(texts, _OTHER), texts, parted)
        split = pc.ascii_split_whitespace(texts)
        stops = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = split.flatten().dictionary_encode()
        get, word = self.cache.get, self.word
        known = [get(w) or word(w) for w in words.dictionary.to_pylist()]
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        at = words.indices.to_numpy()
        own = sizes[at]
        reach = np.cumsum(own)
        total = int(reach[-1]) if len(reach) else 0
        places = np.repeat((starts[at] - (reach - own)).astype(np.int32), own)
        ids = flat[places + np.arange(total, dtype=np.int32)]
        return ids, np.append(0, reach)[stops[1:]]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    """The encoder of a worker process; the file is read once."""
    path = name if os.path.sep in name else public_tokenizers.path(name)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> int:
    """Number of ids."""
    return encoder(name).tokenizer.get_vocab_size(with_added_tokens=True)
