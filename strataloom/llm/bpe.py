"""Byte-level BPE encoding and decoding (operator 3).

Texts are split as the tokenizers library's byte-level pre-tokenizer does, on arrays of bytes; each distinct piece of a
task is encoded once, and a text's ids are gathered from those of its pieces. Pieces are told apart by their bytes, never
by a hash. A long piece that nothing splits is encoded by *tree concatenation*: its leaves apart and in parallel, then, two
by two, growing windows around each join until the first and the last token of the window's encoding are those that the halves
already have. A sequence of tokens is the encoding of its string just where each two neighbours are the encoding of
theirs, so agreement in one token on each side makes the whole exact.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import U64, caches, pieces, prepare, utf8

LEAF, UNSPLIT, KEPT_PIECES = 2048, 4096, 1 << 20
#: Bytes of text that are split at once, ids that are decoded at once, and threads that encode the leaves of a long piece.
BLOCK, DECODED, THREADS = 1 << 20, 1 << 16, 4
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The code points of Unicode's White_Space property, and the endings that an apostrophe takes with it.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    out[WHITE] = SPACE
    return out


def classified(raw: np.ndarray) -> np.ndarray:
    """Of each byte of UTF-8 the class of the character that it belongs to."""
    out = classes()[:256][raw]
    at = 0
    while at < len(raw):  # a block of whole characters at a time
        stop = min(len(raw), at + BLOCK)
        while stop < len(raw) and (raw[stop] & 0xC0) == 0x80:
            stop += 1
        _classify(raw[at:stop], out[at:stop])
        at = stop
    return out


def _classify(raw: np.ndarray, out: np.ndarray) -> None:
    lead = np.flatnonzero(raw >= 0xC0)
    if not len(lead):
        return
    first = raw[lead].astype(np.int64)
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    code = first & (0x7F >> size)
    for k in range(1, 4):
        more = size > k
        code[more] = (code[more] << 6) | (raw[lead[more] + k] & 0x3F)
    kind = classes()[code]
    out[lead] = kind
    for k in range(1, 4):
        more = size > k
        out[lead[more] + k] = kind[more]


def split(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Start byte of every pre-token of texts that stand end to end."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    kind = classified(raw)
    begin = np.zeros(n + 1, bool)  # of texts
    begin[off] = True
    out = begin[:n].copy()
    changed = kind[1:] != kind[:-1]
    changed &= ~begin[1:n]
    out[1:] |= changed
    # The last of a run of white space before something else stands apart; a blank goes with what follows.
    ends = np.flatnonzero(changed)
    del changed
    ends = ends[kind[ends] == SPACE]
    if len(ends):
        wide = raw[ends] >= 0x80
        lone = ends[~wide]
        out[lone] = True
        out[lone + 1] = raw[lone] != 32
        for e in ends[wide].tolist():  # white space of several bytes
            while (raw[e] & 0xC0) == 0x80:
                e -= 1
            out[e] = True
    quotes = np.flatnonzero(out[:n] & (raw == 39))
    quotes = quotes[quotes + 1 < n]
    quotes = quotes[~begin[quotes + 1] & (kind[quotes + 1] == LETTER)]
    for q in quotes.tolist():
        for ending in ENDINGS:
            e = q + 1 + len(ending)
            if raw[q + 1 : e].tobytes() == ending.encode() and not begin[q + 1 : e].any():
                out[q + 1] = False
                if e < n and not begin[e] and kind[e] == LETTER:
                    out[e] = True
                break
    return np.flatnonzero(out)


def stretches(raw: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of about `most` bytes of one text, each split as if it stood alone.

    They end where a letter or number comes before a blank and no more white space, or before a mark that isn't an apostrophe: a
    pre-token starts there whatever stands around. Where a text has no such place a range is longer.
    """
    at, look = 0, 1 << 16
    while at < len(raw):
        stop, near = len(raw), at + most
        while near < len(raw) - 1:
            while (raw[near] & 0xC0) == 0x80 and near < len(raw) - 1:
                near += 1
            far = min(len(raw), near + look)
            while far < len(raw) and (raw[far] & 0xC0) == 0x80:
                far += 1
            part = raw[near:far]
            kind = classified(part)
            word = (kind[:-2] == LETTER) | (kind[:-2] == NUMBER)
            after = ((part[1:-1] == 32) & (kind[2:] != SPACE)) | ((kind[1:-1] == OTHER) & (part[1:-1] != 39) & ((part[1:-1] & 0xC0) != 0x80))
            if len(found := np.flatnonzero(word & after)):
                stop = near + int(found[0]) + 1
                break
            near = max(near + 1, far - 4)
        yield at, stop
        at = stop


def _bytes_of(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Byte strings of a vocabulary in which each byte is written as a printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(back[c] for c in word): i for word, i in vocabulary.items() if all(c in back for c in word)}


class ByteBpe:
    """The tokenizer of a file of the tokenizers library with byte-level pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"] or spec["normalizer"]:
            raise ValueError("only plain byte-level BPE files can be read")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = _bytes_of({k: v for k, v in spec["model"]["vocab"].items() if k not in self.special})
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in pairs]
        if any(x >= y for x, y in zip(made, made[1:], strict=False)):
            raise ValueError("ids must be in the order of the merges")
        self.bpe = tiktoken.Encoding("file", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.token = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.sizes_by_id = np.array([len(self.token.get(i, b"")) for i in range(max(self.token) + 1)])
        self.marks = [(s.encode(), i) for s, i in self.special.items()]
        self.clear()

    def clear(self) -> None:
        """Forgets the pieces that are known: those of less than 8 bytes by their bytes in a number, longer ones by their bytes."""
        self.known, self.number, self.long = np.zeros(0, U64), np.zeros(0, np.int64), {}
        self.place, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    # --- one piece ---

    def tree(self, text: bytes) -> np.ndarray:
        """A long piece: leaves of whole characters in parallel (the encoder works outside Python's lock), then joined two by two."""
        ends = [0]
        while ends[-1] < len(text):
            end = min(len(text), ends[-1] + LEAF)
            while end < len(text) and (text[end] & 0xC0) == 0x80:
                end += 1
            ends.append(end)
        leaf = lambda k: np.array(self.bpe._core_bpe.encode_ordinary(text[ends[k] : ends[k + 1]].decode()), np.uint32)
        with ThreadPoolExecutor(THREADS) as threads:
            parts = list(threads.map(leaf, range(len(ends) - 1)))
        while len(parts) > 1:
            parts = [self.joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else np.zeros(0, np.uint32)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The encoding of two neighbours' string from those of each."""
        if not len(left) or not len(right):
            return left if len(left) else right
        near = 4
        while True:
            a, b = max(0, len(left) - near), min(len(right), near)
            window = self.bpe._core_bpe.encode_single_piece(b"".join(self.token[i] for i in [*left[a:].tolist(), *right[:b].tolist()]))
            if (a == 0 or window[0] == left[a]) and (b == len(right) or window[-1] == right[b - 1]):
                return np.concatenate([left[:a], np.array(window, np.uint32), right[b:]])
            near *= 2

    # --- many texts ---

    def texts(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that stand end to end, and where each text's ids start."""
        ids, count = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i, j in pieces(off, BLOCK):
            part, own = raw[off[i] : off[j]], off[i : j + 1] - off[i]
            whole = part.tobytes()
            if any(m in whole for m, _ in self.marks):
                some = [self._marked(whole[a:b]) for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)]
                n = np.array([len(x) for x in some], np.int64)
                some = np.concatenate(some)
            elif j == i + 1:
                some = self._long(part)
                n = np.array([len(some)])
            else:
                some, n = self._texts(part, own)
            ids.append(some), count.append(n)
        return np.concatenate(ids), np.append(0, np.cumsum(np.concatenate(count)))

    def _long(self, raw: np.ndarray) -> np.ndarray:
        """The ids of one text without special tokens, a stretch at a time."""
        return np.concatenate([np.zeros(0, np.uint32), *[self._texts(raw[a:b], np.array([0, b - a]))[0] for a, b in stretches(raw)]])

    def _marked(self, text: bytes) -> np.ndarray:
        """Special tokens' strings cut a text before all else, leftmost first."""
        parts, at = [np.zeros(0, np.uint32)], 0
        while True:
            hits = [(p, -len(m), m, t) for m, t in self.marks if (p := text.find(m, at)) >= 0]
            stop, _, mark, token = min(hits, default=(len(text), 0, b"", None))
            if stop > at:
                parts.append(self._long(np.frombuffer(text[at:stop], np.uint8)))
            if token is None:
                return np.concatenate(parts)
            parts.append(np.array([token], np.uint32))
            at = stop + len(mark)

    def _texts(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts without special tokens, and how many each has."""
        if len(self.place) > KEPT_PIECES:
            self.clear()
        start = split(raw, off)
        n = np.diff(np.searchsorted(start, off))
        end = np.append(start[1:], len(raw))
        vast = np.flatnonzero(end - start > UNSPLIT)
        ids, size = [np.zeros(0, np.uint32)], np.zeros(len(start), np.int64)
        for a, b in zip([0, *(vast + 1).tolist()], [*vast.tolist(), len(start)], strict=True):
            number = self._numbers(raw, start[a:b], end[a:b])
            size[a:b] = own = self.size[number]
            total = np.cumsum(own)
            ids.append(self.pool[np.arange(own.sum()) + np.repeat(self.place[number] - (total - own), own)])
            if b < len(start):
                ids.append(self.tree(raw[start[b] : end[b]].tobytes()))
                size[b] = len(ids[-1])
        return np.concatenate(ids), np.diff(np.append(0, np.cumsum(size))[np.append(0, np.cumsum(n))])

    def _numbers(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each piece among those known, after encoding those that aren't."""
        out = np.zeros(len(start), np.int64)
        if not len(start):
            return out
        lo = start[0]
        text = raw[lo : end[-1]].tobytes()
        start, size = start - lo, end - start
        short, long = np.flatnonzero(size < 8), np.flatnonzero(size >= 8)
        # A short piece's bytes and its length are one number.
        number = np.ndarray(len(text), "<u8", text + bytes(8), 0, (1,))[start[short]]
        number &= (U64(1) << (size[short] * 8).astype(U64)) - U64(1)
        number |= size[short].astype(U64) << U64(56)
        keys, one, which = np.unique(number, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != keys[inside]
        if new.any():
            first = short[one[new]]
            numbers = self._learned([text[a:b] for a, b in zip(start[first].tolist(), (start + size)[first].tolist(), strict=True)])
            self.known, self.number = np.insert(self.known, at[new], keys[new]), np.insert(self.number, at[new], numbers)
            at = np.searchsorted(self.known, keys)
        out[short] = self.number[at][which]
        words = [text[a:b] for a, b in zip(start[long].tolist(), (start + size)[long].tolist(), strict=True)]
        missing = [w for w in dict.fromkeys(words) if w not in self.long]
        self.long.update(zip(missing, self._learned(missing).tolist(), strict=True))
        out[long] = [self.long[w] for w in words]
        return out

    def _learned(self, words: list[bytes]) -> np.ndarray:
        """Encodes new pieces; their numbers."""
        some = [self.bpe._core_bpe.encode_single_piece(w) for w in words]
        size = np.array([len(x) for x in some], np.int64)
        total = int(size.sum())
        if self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used + 2 * total, np.uint32)])
        self.pool[self.used : self.used + total] = np.fromiter((i for x in some for i in x), np.uint32, total)
        numbers = np.arange(len(self.place), len(self.place) + len(some))
        self.place, self.size = np.append(self.place, self.used + np.cumsum(size) - size), np.append(self.size, size)
        self.used += total
        return numbers

    def decoded(self, ids: np.ndarray) -> Iterator[str]:
        """The text of ids, a block at a time; bytes that aren't UTF-8 become U+FFFD."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for i in range(0, len(ids), DECODED):
            yield reader.decode(b"".join(map(self.token.__getitem__, ids[i : i + DECODED].tolist())))
        yield reader.decode(b"", True)

    def decode(self, ids: np.ndarray) -> str:
        return "".join(self.decoded(ids))


@cache
def loaded(path: str) -> ByteBpe:
    """One tokenizer for each file and process."""
    return ByteBpe(path)


caches.append(loaded.cache_clear)


def standard_path() -> str:
    """The public vocabulary that the registered queries use, where this process has it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _digest(texts: Iterator[str]) -> str:
    out = hashlib.sha256()
    for t in texts:
        out.update(t.encode())
    return out.hexdigest()


def _encode(path: str | None, ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path or standard_path())
        for batch in batches:
            raw, off = utf8(batch["text"])
            got, at = bpe.texts(raw, off)
            n = len(off) - 1
            each = [got[at[i] : at[i + 1]] for i in range(n)]
            out = [batch["doc_id"], pa.array(np.diff(at)), pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each], pa.string())]
            out.append(pa.array([_digest(bpe.decoded(x)) for x in each], pa.string()))
            if ids:
                out.append(pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(out)])

    return of_partition


def encoded(docs: DataFrame, *, path: str | None = None, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids of each row, in one pass without a shuffle.

    Null texts are empty and have no tokens; null and repeated doc_ids return as they are. No rows give no rows.
    """
    prepare(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_encode(path, ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * ids)
