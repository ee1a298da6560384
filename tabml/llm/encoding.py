"""Whole-text tokenisation with a bounded per-worker cache of chunk encodings.

A text is cut at single spaces between two non-space characters. Vocabularies that drop
white space allow more cuts: at any space or line break. No token of either kind reaches across such a cut,
so the chunks' ids, one after the other, are the library's ids for the whole text.
Frequent chunks are encoded once per worker; a new chunk of letters with stops after it
goes to the vocabulary's merge model directly. Vocabularies that drop white space take a block of
texts at once: Arrow tells its distinct chunks apart, by value, and only those are looked up. Where spaces
may not be cut, a text with other white space around a space is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
from pathlib import Path

import numpy as np
import pyarrow as pa

from tabml.llm.text import kept

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE = 250_000  # chunks in each of two generations
LONGEST = 64  # longer chunks are not kept
TOGETHER = 5_000  # new chunks in one call of the merge model
STOPS = string.punctuation.replace("'", "")  # after letters: one piece, where no suffix like 's begins
_OTHER_SPACE = re.compile(r"(?:^|\s) | (?:\s|$)")
_SPACES = bytes.maketrans(b"\n\t\r", b"   ")
_LOWER = bytes(ord(chr(c).lower()) for c in range(256)).translate(_SPACES)  # of Latin-1 bytes


def digest_of(path: str) -> str:
    """Digest of the vocabulary file: the tokenizer's version."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def _byte_characters() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_CHARACTERS = _byte_characters()
_SHOWN = {b: c for b, c in _BYTE_CHARACTERS.items() if b != 32}


def _latin(text: str) -> bool:
    """Only characters up to U+00FF: composed already, and lower case is by character."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Generations:
    """A bounded cache: entries used since the last turnover stay, others go."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def trim(self, added: set[str]) -> None:
        for w in added:
            if len(w) > LONGEST:
                del self.young[w]
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}


class Encoder:
    """Ids of texts by one vocabulary file (``tokenizers`` .json, ``sentencepiece`` .model).

    ``drops_space``: the vocabulary has no token for white space.
    """

    def __init__(self, path: str, drops_space: bool = False):
        self.path, self.drops_space = path, drops_space
        if path.endswith(".model"):
            import sentencepiece

            self.pieces, self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path), None
        else:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.lowers = drops_space and self._encoded(["A"]) == self._encoded(["a"])
            self.by_word, self.last = self._word_model() if drops_space else (None, None)
            probe = ["hello", "straße,", "café.", "ünter!?", "a", "zzqxj...", "$+|", "über_&&&"]
            leads = [""] if drops_space else ["", " "]
            self.direct = all(self._words(probe, x) == self._encoded([x + w for w in probe]) for x in leads)
        self.first, self.rest = Generations(), Generations()  # at a text's start, after a space

    def _encoded(self, texts: list[str]) -> list[bytes]:
        if self.tokenizer is None:
            found = self.pieces.encode(texts, num_threads=1)
        else:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [np.array(ids, "<u4").tobytes() for ids in found]

    def _word_model(self) -> tuple:
        """The merge model over words between spaces, and which ids end a word; None if ids don't show that."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        options = {k: v for k, v in json.loads(Path(self.path).read_bytes())["model"].items() if v is not None}
        suffix = options.get("end_of_word_suffix")
        if options.pop("type") != "BPE" or not suffix or any(c + suffix not in options["vocab"] for c in _BYTE_CHARACTERS.values()):
            return None, None
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in options.pop("merges")]
        # Only new words come here, so the model's own cache would not be hit.
        by_word = Tokenizer(models.BPE(merges=merges, cache_capacity=0, **options))
        by_word.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        last = np.zeros(max(options["vocab"].values()) + 1, bool)
        last[[i for token, i in options["vocab"].items() if token.endswith(suffix)]] = True
        return by_word, last

    def _together(self, words: list[str]) -> list[bytes]:
        """``_words`` in one call: each word's, or its letters' and stops', last id shows where it ends."""
        out, where, pieces, upto, n = [None] * len(words), [], [], [], 0
        for i, w in enumerate(words):
            core = w.rstrip(STOPS)
            if not w or core and not (core.isalpha() and core.islower()):
                continue
            both = core and len(core) < len(w)
            n += 2 if both else 1
            where.append(i)
            pieces.append(f"{core} {w[len(core) :]}" if both else w)
            upto.append(n - 1)
        if where:
            shown = " ".join(pieces).encode().decode("latin-1").translate(_SHOWN)
            ids = np.array(self.by_word.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * (np.flatnonzero(self.last[ids]) + 1)[upto]).tolist()
            body = ids.tobytes()
            for i, a, b in zip(where, [0, *cuts], cuts):
                out[i] = body[a:b]
        return out

    def _words(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of chunks by the merge model alone; None for chunks that need the whole library."""
        if self.by_word and not lead:
            return [ids for i in range(0, len(words), TOGETHER) for ids in self._together(words[i : i + TOGETHER])]
        tokenize, out = self.tokenizer.model.tokenize, []
        for w in words:
            core = w.rstrip(".,!?")
            if not core.isalpha() or self.drops_space and not core.islower():
                out.append(None)
                continue
            tail = w[len(core) :]
            tokens = tokenize((lead + core).encode().decode("latin-1").translate(_BYTE_CHARACTERS))
            if tail:
                tokens += tokenize(tail)
            out.append(np.array([t.id for t in tokens], "<u4").tobytes())
        return out

    def _new(self, words: list[str], lead: str) -> list[bytes]:
        if not self.direct:
            return self._encoded([lead + w for w in words])
        found = self._words(words, lead)
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(rest, self._encoded([lead + words[i] for i in rest])):
            found[i] = ids
        return found

    def _fill(self, words: list[str], cache: Generations, lead: str, plain: bool) -> set[str]:
        """Puts the chunks into the young generation; returns those that were not in it."""
        young, old = cache.young, cache.old
        missing = set(words).difference(young)
        if missing:
            new = []
            for w in missing:
                if w in old:
                    young[w] = old[w]
                else:
                    new.append(w)
            young.update(zip(new, self._new(new, lead) if plain else self._encoded([lead + w for w in new])))
        return missing

    def _chunks(self, words: list[str], cache: Generations, lead: str, plain: bool) -> bytes:
        missing = self._fill(words, cache, lead, plain)
        out = b"".join(map(cache.young.__getitem__, words))
        cache.trim(missing)
        return out

    def _body(self, text: str) -> tuple[bytes, bool]:
        """The text with spaces for line breaks and tabs; plain ones as Latin-1, in lower case where that is the same."""
        if "<|" not in text:
            try:
                return text.encode("latin-1").translate(_LOWER if self.lowers else _SPACES), True
            except UnicodeEncodeError:
                pass
        return text.encode().translate(_SPACES), False

    def _bodies(self, bodies: list[bytes], plain: bool) -> list[bytes]:
        """Ids of the texts of a block; each chunk is its bytes and the space after it."""
        data = b" ".join(bodies) + b" "
        offsets = np.concatenate(([0], np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1))
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
        _, where, found = chunks.dictionary.buffers()
        upto = int(np.frombuffer(where, np.int64)[len(chunks.dictionary)])
        words = str(found[:upto], "latin-1" if plain else "utf-8").split(" ")[:-1]
        missing = self._fill(words, self.rest, "", plain)
        ids = pa.array(list(map(self.rest.young.__getitem__, words)), pa.large_binary()).take(chunks.indices)
        self.rest.trim(missing)
        _, where, found = ids.buffers()
        first = np.searchsorted(offsets, np.cumsum([0] + [len(b) + 1 for b in bodies]))
        cuts = np.frombuffer(where, np.int64)[first].tolist()
        return [found[a:b].to_pybytes() if b > a else b"" for a, b in zip(cuts, cuts[1:])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` for each text of a block."""
        if self.tokenizer is None or not self.drops_space:
            return [self.encode(t) for t in texts]
        out = [b""] * len(texts)
        bodies = [self._body(t) for t in texts]
        for plain in (True, False):
            those = [i for i, (_, p) in enumerate(bodies) if p is plain]
            if those:
                for i, ids in zip(those, self._bodies([bodies[i][0] for i in those], plain)):
                    out[i] = ids
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.tokenizer is None:
            return self._encoded([text])[0]
        if self.drops_space:
            return self.encode_all([text])[0]
        if _OTHER_SPACE.search(text):
            return self._encoded([text])[0]
        plain = "<|" not in text and _latin(text)
        head, *tail = text.split(" ")
        return self._chunks([head], self.first, "", plain) + self._chunks(tail, self.rest, " ", plain)

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4


def encoder(path: str, drops_space: bool = False) -> Encoder:
    """The worker's encoder for a file, loaded once and kept while the tasks that follow keep it."""
    key = (path, drops_space)
    if key not in kept:
        kept[key] = Encoder(path, drops_space)
    return kept[key]
