"""Token ids of whole texts by the tokenizers library, part by part where the tokenizer allows it.

A tokenizer whose pre-tokeniser keeps runs of letters, single digits and runs of other marks, and drops white space, gives
a text the ids of its words one after another, and a word those of its parts. For such a file a batch's texts are split at
ASCII white space, and only its distinct words are looked at: a word of letters and then marks is two parts, any other word
is cut by PARTS. The ids of the first KEPT parts are kept for the life of the Python worker, those of the rest for one
slice of a batch; every distinct part that isn't kept goes through the library. All but the library's own work is Arrow
and numpy over a slice of SLICE bytes. Any other file gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"  # composed Latin letters whose lower case is one letter
SAFE = r"!-&(-;=-@\[-`{-~"  # ASCII digits and marks but for the apostrophe (contractions) and < (special tokens)
SPACES = r" \t\n\r\x0b\x0c"
#: Letters up to a space or safe mark; safe marks up to a space or letter; else all up to a space. No pre-token crosses these cuts.
PARTS = re.compile(f"[{LETTER}]++(?=[{SPACES}{SAFE}]|\\Z)|[{SAFE}]++(?=[{SPACES}{LETTER}]|\\Z)|[^{SPACES}]++")
#: The same for most words: letters, then marks.
PLAIN = f"^(?P<letters>[{LETTER}]*)(?P<marks>[{SAFE}]*)$"
KEPT, SLICE, TOGETHER = 400_000, 4 << 20, 512
LETTERS_ONLY = re.compile(f"[{LETTER}]+\\Z")


def drops_space(config: dict) -> bool:
    """Whether the first pre-tokenising step keeps only matches of a pattern that can't hold white space."""
    steps = config.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    first = steps[0] if steps else {}
    pattern = first.get("pattern", {}).get("Regex", "")
    normal = (config.get("normalizer") or {}).get("normalizers", [{}])
    plain = all(n.get("type") in ("NFC", "Replace", "Lowercase") for n in normal)
    known = r"'[a-z]+|\[?\\p\{[LN]\}\]?\+?|\[\^\\s\\p\{L\}\\p\{N\}\]\+"
    other = [x for x in pattern.split("|") if not re.fullmatch(known, x)]
    removes = first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
    return plain and removes and bool(pattern) and not other and not config.get("post_processor")


def gathered(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches pool[start : start + size], one after another."""
    end = np.cumsum(size)
    return pool[np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


class WordIds:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.by_part = drops_space(config)
        suffix = config["model"].get("end_of_word_suffix")
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size(True)))
        #: ids that end a word, where the vocabulary marks them.
        self.ends = np.array([bool(suffix) and (t or "").endswith(suffix) for t in names])
        self._forget()

    def _forget(self) -> None:
        #: Kept parts; their ids stand in pool, those of part k from start[k] on, size[k] of them.
        self.parts = pa.array([], pa.string())
        self.pool = np.zeros(0, np.uint32)
        self.start = self.size = np.zeros(0, np.int64)
        self.seen = self.missed = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of letters and their numbers: many at a time, cut after the ids that end a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        end = np.flatnonzero(self.ends[ids]) + 1
        if len(end) == len(words) and end[-1] == len(ids):
            return ids, np.diff(end, prepend=0)
        raw = self._encode(words)
        return np.frombuffer(b"".join(raw), np.uint32), np.array([len(x) // 4 for x in raw], np.int64)

    def _new(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts by the library, one after another, and how many each has."""
        letters = np.array([LETTERS_ONLY.match(p) is not None for p in parts], bool)
        ids, size = [np.zeros(0, np.uint32)], np.zeros(len(parts), np.int64)
        for chosen in (np.flatnonzero(letters), np.flatnonzero(~letters)):
            for at in range(0, len(chosen), TOGETHER):
                some = chosen[at : at + TOGETHER]
                words = [parts[i] for i in some.tolist()]
                if letters[some[0]]:
                    found, size[some] = self._encode_words(words)
                else:
                    raw = self._encode(words)
                    found, size[some] = np.frombuffer(b"".join(raw), np.uint32), [len(x) // 4 for x in raw]
                ids.append(found)
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        start = np.zeros(len(parts), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        return gathered(np.concatenate(ids), start, size), size

    def _of_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """pool, start and size of the ids of distinct parts."""
        at = pc.index_in(parts, value_set=self.parts)
        missing = np.flatnonzero(at.is_null())
        self.seen, self.missed = self.seen + len(parts), self.missed + len(missing)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        start, size = (x[at] if len(x) else np.zeros(len(at), np.int64) for x in (self.start, self.size))
        if not len(missing):
            return self.pool, start, size
        new = parts.take(pa.array(missing))
        ids, many = self._new(new.to_pylist())
        size[missing] = many
        start[missing] = len(self.pool) + np.cumsum(many) - many
        pool = np.concatenate([self.pool, ids])
        room = KEPT - len(self.parts)
        if room > 0:
            self.parts = pa.concat_arrays([self.parts, new.slice(0, room)])
            self.start, self.size = np.concatenate([self.start, start[missing[:room]]]), np.concatenate([self.size, many[:room]])
            self.pool = pool[: self.start[-1] + self.size[-1]]
        elif self.missed > 0.5 * self.seen > 5 * KEPT:  # what comes early is mostly what is common - unless the texts have changed
            self._forget()
        return pool, start, size

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """pool, start and size of the ids of distinct words."""
        two = pc.extract_regex(words, PLAIN)
        plain = two.is_valid()
        odd = [PARTS.findall(w) for w in words.filter(pc.invert(plain)).to_pylist()]
        two = two.filter(plain)
        every = pa.concat_arrays([two.field("letters"), two.field("marks"), pa.array([p for ps in odd for p in ps], pa.string())])
        coded = every.dictionary_encode()
        pool, start, size = self._of_parts(coded.dictionary)
        code, n = coded.indices.to_numpy(), len(two)
        # parts of the words, word by word: of plain ones two, of the others as many as there are
        number = np.full(len(words), 2, np.int64)
        number[np.flatnonzero(~plain.to_numpy(zero_copy_only=False))] = [len(ps) for ps in odd]
        turn = np.concatenate([code[: 2 * n].reshape(2, n).T.reshape(-1), code[2 * n :]])
        first = np.zeros(len(words), np.int64)
        is_plain = plain.to_numpy(zero_copy_only=False)
        first[is_plain], first[~is_plain] = 2 * np.arange(n), 2 * n + np.cumsum(number[~is_plain]) - number[~is_plain]
        turn = gathered(turn, first, number)
        after = np.concatenate([[0], np.cumsum(size[turn])])
        end = np.cumsum(number)
        return gathered(pool, start[turn], size[turn]), after[end - number], after[end] - after[end - number]

    def _slices(self, texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
        """Texts of some SLICE bytes together, with their numbers; longer texts are cut at a space."""
        size = pc.binary_length(texts).to_numpy()
        at = 0
        while at < len(texts):
            n = max(1, int(np.searchsorted(np.cumsum(size[at : at + (1 << 16)]), SLICE, side="right")))
            if n == 1 and size[at] > SLICE:
                text, done = texts[at].as_py(), 0
                while done < len(text):
                    end = min(len(text), done + SLICE)
                    while end < len(text) and text[end] not in " \n":
                        end += 1
                    yield pa.array([text[done:end]]), np.array([at])
                    done = end
            else:
                yield texts.slice(at, n), np.arange(at, at + n)
            at += n

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (none null), one after another, and how many each has."""
        size = np.zeros(len(texts), np.int64)
        if not self.by_part:
            raw = self._encode(texts.to_pylist())
            return np.frombuffer(b"".join(raw), np.uint32), np.array([len(x) // 4 for x in raw], np.int64)
        out = [np.zeros(0, np.uint32)]
        for some, number in self._slices(texts):
            # A-Z only, the rest is the library's; lower case could make a special token's string of another
            lower = pc.if_else(pc.match_substring(some, "<|"), some, pc.ascii_lower(some))
            split = pc.ascii_split_whitespace(lower)
            coded = split.flatten().dictionary_encode()
            pool, start, many = self._of_words(coded.dictionary)
            code = coded.indices.to_numpy()
            many_here = many[code]
            out.append(gathered(pool, start[code], many_here))
            after = np.concatenate([[0], np.cumsum(many_here)])
            offsets = split.offsets.to_numpy()
            np.add.at(size, number, after[offsets[1:]] - after[offsets[:-1]])
        return np.concatenate(out), size

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        ids, size = self.batch(pa.array(texts, pa.string()))
        raw, end = ids.tobytes(), 4 * np.cumsum(size)
        return [raw[a:z] for a, z in zip((end - 4 * size).tolist(), end.tolist(), strict=True)]

    def ids(self, text: str) -> bytes:
        return self.many([text])[0]


_OPEN: dict[str, WordIds] = {}


def opened(path: str) -> WordIds:
    """One per Python worker and file."""
    if path not in _OPEN:
        _OPEN[path] = WordIds(path)
    return _OPEN[path]
