"""Public vocabulary files, loaded once in each Python worker.

Texts are split into words, and each distinct word is encoded once per
worker, by the tokenizer itself; a bounded cache keeps the result.  A text
with characters whose classes the splitting patterns here do not cover (other
than printable ASCII, line ends and Latin-1 letters) goes to the tokenizer as
it is.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_ENTRIES = 160_000
#: Text encoded at a time: a word costs much more memory as an object than as text.
TOKEN_SLICE_BYTES = 2 << 20


@functools.lru_cache(maxsize=4)
def tiktoken_encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: White space as the splitting patterns know it, in runs that their search would need a deep stack for.
_LONG_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def ordinary_ids(encoding, text: str) -> list[int]:
    """Ids of a whole text, as ``encode_ordinary`` gives them, whatever runs
    of white space it holds.  The splitting pattern takes such a run as one
    word, but for its last character where something follows; long runs are
    cut out by that rule and go to the merges directly."""
    run = _LONG_WHITE.search(text)
    if run is None:
        return encoding.encode_ordinary(text)
    out, at = [], 0
    while run is not None:
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += encoding.encode_ordinary(text[at:run.start()])
        out += encoding._encode_single_piece(text[run.start():end])
        at = end
        run = _LONG_WHITE.search(text, run.end())
    return out + encoding.encode_ordinary(text[at:])


def byte_alphabet() -> dict[int, str]:
    """For str.translate of text read as Latin-1: the character that stands
    for each byte in byte-level vocabularies.  Printable Latin-1 characters
    stand for themselves, the other bytes for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


# Classes of the bytes of plain texts: printable ASCII, line ends, and Latin-1 letters, which are C3 and a second byte.
_WHITE, _LETTER, _NUMBER, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[10, 32]] = _WHITE
_CLASS[48:58] = _NUMBER
_CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = _LETTER
_PLAIN = np.zeros(256, bool)
_PLAIN[[10, *range(32, 127), *range(0x80, 0xC0), 0xC3]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Marked bytes of each text."""
    return np.diff(np.searchsorted(np.flatnonzero(marks), bounds))


class PieceEncoder:
    """Token ids, as little-endian unsigned 32-bit integers, of whole texts.

    Texts are split into words as the tokenizer does, and new words go
    through its merges together, in lists of ``GROUP``.  With ``spaces`` (a
    tokenizer that keeps white space) most words carry the space before them,
    and tokens that begin with a space mark where words begin; a control
    character stands between the others.  Without (white space is dropped,
    case is folded) tokens with the word-end suffix mark where words end.

    The cache has two generations: at ``CACHE_ENTRIES`` the younger becomes
    the older, and what is still in use moves back."""

    GROUP = 2000

    def __init__(self, tokenizer, spaces: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.spaces = tokenizer, spaces
        self.merges = Tokenizer(tokenizer.model)  # the vocabulary and its merges alone, for words in its byte alphabet
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.alphabet = byte_alphabet()
        self.lines = self.alphabet | {10: "\n"}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        if spaces:
            self.bound = np.array([x.startswith(self.alphabet[32]) for x in names])
            self.mark = names.index(self.alphabet[1])  # of a byte that no word holds
        else:
            self.bound = np.array([x.endswith(tokenizer.model.end_of_word_suffix) for x in names])

    def forget(self) -> None:
        """Empties the cache and gives freed buffers back: a worker that waits
        for a task holds memory too."""
        self.young, self.old = {}, {}
        pa.default_memory_pool().release_unused()

    def whole(self, texts: list[str], tokenizer=None) -> list[bytes]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that the splitting pattern leaves in one part."""
        if not self.spaces:
            return self._encode_groups(words, lambda ids: [0, *(np.flatnonzero(self.bound[ids]) + 1).tolist()])
        white = [w for w in words if w.isspace()]
        spaced = [w for w in words if w[0] == " " and not w.isspace()]
        other = [w for w in words if w[0] != " " and not w.isspace()]
        return self._encode_groups(spaced, lambda ids: [*np.flatnonzero(self.bound[ids]).tolist(), len(ids)]) | \
            self._encode_groups(other, lambda ids: [-1, *np.flatnonzero(ids == self.mark).tolist()], f" {self.alphabet[1]}", 1) | \
            dict(zip(white, self.whole(white)))

    def _encode_groups(self, words: list[str], bounds, end: str = "", skip: int = 0) -> dict[str, bytes]:
        """Ids of words without line ends, many in one text, a line each;
        ``bounds`` finds where each begins (less ``skip``) and the last ends.
        Where that doesn't give as many words as went in, they go in one by
        one."""
        done: dict[str, bytes] = {}
        groups = [words[i: i + self.GROUP] for i in range(0, len(words), self.GROUP)]
        # In the byte alphabet, in which a line end stays what it is.
        joined = ["\n".join(g).encode().decode("latin-1").translate(self.lines).replace("\n", end + "\n") + end for g in groups]
        for group, raw in zip(groups, self.whole(joined, self.merges)):
            cuts = bounds(np.frombuffer(raw, "<u4"))
            if len(cuts) != len(group) + 1:
                done.update(zip(group, self.whole(group)))
            else:
                done.update((w, raw[4 * (a + skip): 4 * b]) for w, a, b in zip(group, cuts, cuts[1:]))
        return done

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words.  Without ``spaces`` white space has none."""
        if len(self.young) > CACHE_ENTRIES:
            self.old, self.young = self.young, {}
        got = list(map(self.young.get, words))
        if None in got:
            lacking = [w for w, x in zip(words, got) if x is None]
            found = {w: x for w in lacking if (x := self.old.get(w)) is not None}
            new = [w for w in lacking if w not in found]
            if not self.spaces:
                found |= {w: b"" for w in new if w[0] in " \n"}
                new = [w for w in new if w[0] not in " \n"]
            if new:
                found |= self._encode_words(new)
            self.young |= found
            got = [found[w] if x is None else x for w, x in zip(words, got)]
        return got

    def _starts(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Whether a piece begins at each byte of the texts, which begin at
        ``begin``: the splitting patterns, for texts of the plain characters.

        Pieces are runs of letters, of digits (without ``spaces``: single
        ones), of other characters, and of white space, but for contractions
        and, with ``spaces``, the space that goes with the next piece."""
        n = len(data)
        kind = _CLASS[data]
        first = np.zeros(n + 3, bool)
        first[begin] = True
        starts = np.zeros(n + 3, bool)
        starts[1:n] = kind[1:] != kind[:-1]
        starts[:n] |= first[:n]
        if self.spaces:
            # A white run before something else gives up its last character: a space to what follows, a line end by itself.
            follows = np.flatnonzero(starts[1:n] & ~first[1:n] & (kind[:-1] == _WHITE)) + 1
            starts[follows - 1] = True
            starts[follows[data[follows - 1] == 32]] = False
        else:
            starts[:n] |= kind == _NUMBER
        at = np.flatnonzero((data == 39) & starts[:n])
        if len(at):
            after = np.concatenate([data, np.zeros(3, np.uint8)])
            one, two = after[at + 1], after[at + 2]
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & ~first[at + 1]
            pair = one.astype(np.int64) * 256 + two
            long = np.isin(pair, [114 * 256 + 101, 118 * 256 + 101, 108 * 256 + 108]) & ~first[at + 1] & ~first[at + 2]  # re, ve, ll
            starts[at[short | long] + 1] = False
            starts[at[short] + 2] = True
            starts[at[long] + 3] = True
        return starts[:n]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text; null is empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        n = len(column)
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64, n + 1, 8 * column.offset) if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.empty(0, np.uint8)
        bounds = bounds - bounds[0]
        # A text with any other character than the plain ones goes to the tokenizer as it is.
        bad = ~_PLAIN[raw]
        lead = np.flatnonzero(raw == 0xC3)
        second = np.append(raw, 0)[lead + 1]
        bad[lead] = (second == 0x97) | (second == 0xB7)  # the two signs among the Latin-1 letters
        bad[1:] |= (raw[1:] >= 0x80) & (raw[1:] < 0xC0) & (raw[:-1] != 0xC3)
        plain = _per_text(bad, bounds) == 0
        if not plain.all():
            inside = np.repeat(plain, np.diff(bounds))
            raw = raw[inside]
        sizes = np.where(plain, np.diff(bounds), 0)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        if not self.spaces:
            raw = _LOWER[raw]
            second = np.flatnonzero(raw[:-1] == 0xC3) + 1
            upper = second[(raw[second] >= 0x80) & (raw[second] < 0x9F)]
            raw[upper] += 32
        starts = np.flatnonzero(self._starts(raw, begin[sizes > 0])) if len(raw) else np.empty(0, np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)])
        coded = pieces.dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.cast(pa.large_string()).to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        # The ids of all pieces one after another, and where each text's begin.
        _, offsets, data = ids.buffers()
        count = np.searchsorted(starts, np.append(begin, len(raw)))
        cut = np.frombuffer(offsets, np.int64, len(starts) + 1, 8 * ids.offset)[count].tolist() if len(starts) else [0] * len(count)
        data = memoryview(data) if data is not None else b""
        odd = iter(self.whole([column[i].as_py().decode() for i in np.flatnonzero(~plain).tolist()]))
        return [bytes(data[a:b]) if p else next(odd) for p, a, b in zip(plain.tolist(), cut, cut[1:])]


@functools.lru_cache(maxsize=4)
def tokenizers_encoder(path: str, spaces: bool) -> PieceEncoder:
    """A vocabulary of the tokenizers library.  Strings of its special tokens
    in a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return PieceEncoder(t, spaces)
