"""The tokenizers library with a bounded cache of white-space-parted chunks.

Both vocabularies used here never join what stands on two sides of a chunk's
border, so that a text's ids are its chunks' ids in order:

* ``"word"``: white space is dropped and parts tokens; chunks are what ASCII white
  space parts. ASCII letters are lowered first, as the library's normaliser does.
* ``"byte"``: a match of the byte-level pattern never goes on past white space
  that follows other characters; a chunk is a run of white space and the other characters after it.

In both, a comma or full stop that follows a letter or digit starts a match, so a chunk ends there too.

Texts are cut, made distinct and put together again by Arrow and numpy, a batch at
a time. Only chunks that aren't in the cache go to the library, many in one text:
plain words as they are, told apart by the tokens that start or end a word; any
other chunk between two added tokens, which the library cuts out first.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .resident import resident

# Unicode White_Space, as the library's byte-level pattern has it.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

#: Stands between chunks; a text that holds it is a chunk of its own.
CUT = "\ufdd0"
#: Bytes of text cut and put together at a time.
PIECE = 1 << 21
#: Chunks that go to the library in one text.
TOGETHER = 4_000
_POINTS = r"[^\pL\pN][.,]"


def _parted(texts: pa.Array, mark: str) -> pa.Array:
    """The texts with ``mark`` before commas and full stops, unless one of the text follows neither letter nor digit."""
    marked = pc.replace_substring(pc.replace_substring(texts, ",", f"{mark},"), ".", f"{mark}.")
    return pc.if_else(pc.match_substring_regex(texts, _POINTS), texts, marked)


def split_words(texts: pa.Array) -> pa.ListArray:
    added = pc.match_substring(texts, "<|")  # else an added token could come about
    return pc.ascii_split_whitespace(_parted(pc.if_else(added, texts, pc.ascii_lower(texts)), " "))


def split_bytes(texts: pa.Array) -> pa.ListArray:
    runs = pc.match_substring_regex(texts, f"[{SPACE}]{{2}}")
    cut = pc.replace_substring(texts, " ", f"{CUT} ")
    if pc.any(runs).as_py():
        cut = pc.if_else(runs, pc.replace_substring_regex(texts, f"([^{SPACE}])([{SPACE}])", f"\\1{CUT}\\2"), cut)
    return pc.split_pattern(_parted(cut, CUT), CUT)


class ChunkEncoder:
    """Encodes texts to ids of ``dtype``; keeps the ids of at most ``cache`` chunks of up to 64 characters."""

    def __init__(self, path: str, kind: str, dtype: str = "<u4", cache: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.limit = Tokenizer.from_file(path), np.dtype(dtype), cache
        self.split = split_bytes if kind == "byte" else split_words
        self.known: dict[str, int] = {"": 0}
        self.flat, self.begin, self.size = np.empty(0, self.dtype), np.zeros(1, np.int64), np.zeros(1, np.int64)
        # An added token that is cut out of a text before anything else looks at it parts chunks without touching them.
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        whole = [(i, t.content) for i, t in added.items() if not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.parting_id, self.parting = whole[-1] if whole else (-1, "")
        # Plain words, and the ids that start (byte: a space) or end (word: its mark) one.
        self.plain = "^ [A-Za-zÀ-ÖØ-öø-ÿ]+$" if kind == "byte" else "^[a-zß-öø-ÿ]+$"
        self.glue, self.first = ("", True) if kind == "byte" else (" ", False)
        self.edge = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.edge[i] = token.startswith("\u0120") if self.first else token.endswith("</w>")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self._ids(self.glue.join(chunks))
        cut = np.flatnonzero(self.edge[got])
        return got, np.diff(np.append(cut, len(got)) if self.first else np.append(-1, cut))

    def _apart(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self._ids(self.parting + self.parting.join(chunks) + self.parting)
        mark = got == self.parting_id
        return got[~mark], np.diff(np.flatnonzero(mark)) - 1

    def _each(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [self._ids(c) for c in chunks]
        return np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))

    def _learn(self, new: list[str]) -> tuple[np.ndarray, int]:
        """Adds the ids of chunks to the cache, those of up to 64 characters first: the chunks' numbers, and how many are so short."""
        column = pa.array(new, pa.string())
        plain = pc.match_substring_regex(column, self.plain).to_numpy(zero_copy_only=False)
        kind = np.where(plain, 0, 1 if self.parting else 2)
        for x in self.added:
            kind[~plain & pc.match_substring(column, x).to_numpy(zero_copy_only=False)] = 2
        long = pc.utf8_length(column).to_numpy() > 64
        order = np.lexsort((kind, long))
        flat, size = [self.flat], [self.size]
        for late in (False, True):
            for k, encode in enumerate((self._plain, self._apart, self._each)):
                some = np.flatnonzero((kind == k) & (long == late)).tolist()
                for a in range(0, len(some), TOGETHER):
                    part = [new[i] for i in some[a : a + TOGETHER]]
                    ids, n = encode(part)
                    if len(n) != len(part):
                        raise ValueError("the library's tokens don't tell its words apart")
                    flat.append(ids)
                    size.append(n)
        number = np.empty(len(new), np.int64)
        number[order] = len(self.size) + np.arange(len(new))
        self.known.update(zip(new, number.tolist(), strict=True))
        self.flat, self.size = np.concatenate(flat), np.concatenate(size)
        self.begin = np.cumsum(self.size) - self.size
        return number, int((~long).sum())

    def _forget(self, new: list[str], number: np.ndarray, chunks: int) -> None:
        """Goes back to the first ``chunks`` chunks."""
        for i in np.flatnonzero(number >= chunks).tolist():
            del self.known[new[i]]
        used = int(self.begin[chunks])
        self.flat, self.begin, self.size = self.flat[:used].copy(), self.begin[:chunks], self.size[:chunks]

    def encode_array(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), ``end`` after each if given, and how many each text has."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring(texts, CUT)
        lists = self.split(pc.if_else(odd, "", texts) if pc.any(odd).as_py() else texts)
        coded = lists.flatten().dictionary_encode()
        words = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), CUT)[0].as_py().split(CUT) if len(coded.dictionary) else []
        offsets = lists.offsets.to_numpy().astype(np.int64)
        at = coded.indices.to_numpy()
        rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(rows):  # such a text is one chunk
            place = np.searchsorted(rows, np.arange(len(texts)))
            at = np.insert(at, offsets[rows + 1], np.arange(len(words), len(words) + len(rows)))
            offsets = offsets + np.append(place, len(rows))
            words += texts.take(pa.array(rows)).to_pylist()
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(found < 0)
        before, new, numbers, short = len(self.size), [], unknown, 0
        if len(unknown):
            new = list(dict.fromkeys(words[i] for i in unknown.tolist()))
            numbers, short = self._learn(new)
            found[unknown] = numbers if len(new) == len(unknown) else [self.known[words[i]] for i in unknown.tolist()]
        number = found[at]
        size = self.size[number]
        # Ids before each chunk; a text's end id takes a place after its chunks.
        upto = np.concatenate([[0], np.cumsum(size)])
        count = np.diff(upto[offsets])
        total = int(upto[-1])
        ids = self.flat[np.repeat(self.begin[number] - upto[:-1], size) + np.arange(total)]
        if end is not None:
            ids = np.insert(ids, upto[offsets[1:]], end)
            count = count + 1
        if len(self.known) > self.limit:  # what came first stays: common chunks come early
            short = 0
        if short < len(new):
            self._forget(new, numbers, before + short)
        return ids, count

    def encode(self, rows: list[str]) -> list[bytes]:
        ids, count = self.encode_array(pa.array(rows, pa.string()))
        stop = np.cumsum(count)
        return [ids[a:b].tobytes() for a, b in zip((stop - count).tolist(), stop.tolist(), strict=True)]


def blobs(ids: np.ndarray, count: np.ndarray) -> pa.Array:
    """Ids of several texts as a binary array, a text an element."""
    width = ids.dtype.itemsize
    offsets = np.concatenate([[0], np.cumsum(count)]) * width
    small = offsets[-1] < 1 << 31
    kind = pa.binary() if small else pa.large_binary()
    return pa.Array.from_buffers(kind, len(count), [None, pa.py_buffer(offsets.astype(np.int32 if small else np.int64)), pa.py_buffer(np.ascontiguousarray(ids))])


def chunk_encoder(path: str, kind: str, dtype: str = "<u4") -> ChunkEncoder:
    """One for each worker process, so that its cache outlives a task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return resident(("chunks", path, kind, dtype), lambda: ChunkEncoder(path, kind, dtype))
