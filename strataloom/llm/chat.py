"""Chat formatting with offset-aligned loss masks (operator 4).

A conversation is rendered whole, its control strings stand apart as tokens of their own, and it is encoded once, with
offsets. The loss mask over tokens comes from two sorted lists of spans, the assistant's turns and the tokens, by binary
search. Everything returned is read back from the rendered text and the mask.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.bpe import ByteBpe, loaded, standard_path
from strataloom.llm.common import even_keys, partitions, prepare

#: A turn is OPEN, its role, HEAD, its text, CLOSE. ESCAPE before a character of a text or role keeps it from being one.
OPEN, HEAD, CLOSE, ESCAPE = "<turn>", "<says>", "</turn>", "\\"
CONTROL = re.compile("|".join(map(re.escape, (OPEN, HEAD, CLOSE))))
SPECIAL = re.compile(r"\\|<(?=turn>|says>|/turn>)")
LOSS_ROLE = "assistant"
#: Characters of a conversation that are held at once.
BLOCK = 1 << 22


def escaped(text: str) -> str:
    """The text with a backslash before each backslash and before each `<` that would begin a control string."""
    return SPECIAL.sub(lambda m: ESCAPE + m[0], text)


def unescaped(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


def rendered(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{OPEN}{escaped(role)}{HEAD}{escaped(text)}{CLOSE}" for role, text in turns)


def controls(text: str) -> list[tuple[int, int, str]]:
    """The control strings of a rendered text: those that no backslash escapes."""
    found = []
    for m in re.finditer(r"(?s)\\.|" + CONTROL.pattern, text):
        if m[0][0] != ESCAPE:
            found.append((m.start(), m.end(), m[0]))
    return found


def parsed(text: str) -> list[tuple[str, int, int]]:
    """Role, start and end of the text of each turn, as they stand in the rendered text."""
    marks = controls(text)
    out = []
    for (a, b, x), (c, d, y), (e, _, z) in zip(marks[::3], marks[1::3], marks[2::3], strict=True):
        if (x, y, z) != (OPEN, HEAD, CLOSE):
            raise ValueError("not a rendered conversation")
        out.append((unescaped(text[b:c]), d, e))
    return out


def encoded(text: str, bpe: ByteBpe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a rendered text and each token's start and end in code points; control strings are tokens above the vocabulary.

    A token that is part of a character has that character's span.
    """
    names = {OPEN: 0, HEAD: 1, CLOSE: 2}
    base = len(bpe.sizes_by_id)
    marks = controls(text)
    cuts = [0, *[x for a, b, _ in marks for x in (a, b)], len(text)]
    parts = [text[a:b].encode() for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
    off = np.append(0, np.cumsum([len(p) for p in parts]))
    ids, at = bpe.texts(np.frombuffer(b"".join(parts), np.uint8), off)
    size = bpe.sizes_by_id[ids]
    controls_at = at[1:-1]
    ids = np.insert(ids, controls_at, [base + names[x] for _, _, x in marks])
    size = np.insert(size, controls_at, [b - a for a, b, _ in marks])  # they are ASCII
    end = np.cumsum(size)
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.append(np.cumsum((raw & 0xC0) != 0x80), len(text) + 1) - 1  # of each byte
    return ids, char[end - size], char[end - 1] + 1


def masked(spans: list[tuple[int, int]], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which tokens lie in a span. Both lists are sorted: each span's tokens are a range found by binary search."""
    mask = np.zeros(len(start), bool)
    for a, b in spans:
        mask[bisect_left(start, a) : bisect_left(end, b + 1)] = True
    return mask


class Conversation:
    """What is read back from a conversation's rendered text, ids and mask, a block of turns at a time.

    A conversation is one block unless it is longer than BLOCK characters. Blocks end between turns, where a control string
    cuts the text for the tokenizer too, so the blocks' encodings end to end are that of the whole.
    """

    def __init__(self, bpe: ByteBpe, outputs: bool = False):
        self.bpe, self.outputs = bpe, outputs
        self.turns: list[tuple[str, str]] = []
        self.size = self.n_turns = self.loss_chars = self.chars = self.n_tokens = self.loss_tokens = 0
        self.digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()
        self.made: list[tuple] = []

    def add(self, role: str, text: str) -> None:
        self.turns.append((role, text))
        self.size += len(role) + len(text)
        if self.size > BLOCK:
            self.block()

    def block(self) -> None:
        text = rendered(self.turns)
        self.turns, self.size = [], 0
        back = parsed(text)
        ids, start, end = encoded(text, self.bpe)
        spans = [(a, b) for role, a, b in back if role == LOSS_ROLE]
        mask = masked(spans, start, end)
        on = np.flatnonzero(mask)
        # Masked characters, from the tokens' spans; a character of several tokens counts once. Turns are unescaped one by one.
        for a, b in spans:
            own = on[np.searchsorted(start[on], a) : np.searchsorted(start[on], b)]
            said = unescaped(text[start[own[0]] : end[own[-1]]]) if len(own) else ""
            self.loss_chars += len(said)
            self.loss_digest.update(said.encode())
        for role, a, b in back:
            self.digest.update(f"{role}\n{unescaped(text[a:b])}\n".encode())
        self.n_turns, self.chars = self.n_turns + len(back), self.chars + len(text)
        self.n_tokens, self.loss_tokens = self.n_tokens + len(ids), self.loss_tokens + int(mask.sum())
        if self.outputs:
            self.made.append((text, ids, mask))

    def row(self) -> dict:
        self.block()
        out = {"n_turns": self.n_turns, "turns_sha256": self.digest.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss_digest.hexdigest(), "formatted_chars": self.chars, "n_tokens": self.n_tokens, "loss_tokens": self.loss_tokens}
        if self.outputs:
            text, ids, mask = zip(*self.made, strict=True)
            out |= {"text": "".join(text), "ids": np.concatenate(ids), "mask": np.concatenate(mask)}
        return out


def formatted(turns: list[tuple[str, str]], bpe: ByteBpe) -> dict:
    """A conversation's rendered text, ids and mask, and what is read back from them."""
    conversation = Conversation(bpe, outputs=True)
    for role, text in turns:
        conversation.add(role, text)
    return conversation.row()


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"
OUTPUTS = ", text string, ids array<long>, mask array<boolean>"


def _format(path: str | None, outputs: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    fields = [x.split()[0] for x in (DIGESTS + OUTPUTS * outputs).split(", ")]
    kinds = dict.fromkeys(fields, pa.int64()) | {"turns_sha256": pa.string(), "loss_sha256": pa.string(), "text": pa.string(), "ids": pa.list_(pa.int64()), "mask": pa.list_(pa.bool_())}

    def rows(of: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[f] for r in of], kinds[f]) for f in fields], fields)

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path or standard_path())
        done: list[dict] = []
        now, conversation = None, None
        for batch in batches:
            for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conversation is None or conv != now:
                    done += [conversation.row() | {"conv_id": now}] if conversation else []
                    now, conversation = conv, Conversation(bpe, outputs)
                conversation.add(role, text)
            if done:
                yield rows(done)
                done = []
        if conversation:
            yield rows([conversation.row() | {"conv_id": now}])

    return of_partition


def chats(conversations: DataFrame, *, path: str | None = None, outputs: bool = False) -> DataFrame:
    """One row for each conv_id: the digests and, if asked for, the text, ids and loss mask.

    Rows of a conversation are in the order of turn (null first), then role, then text. Null texts and roles are empty; rows
    with a null conv_id are one conversation, with a null id. Repeated rows are turns of their own. No rows give no rows. A
    task holds one conversation at a time, as its digest and its encoding are of the whole.
    """
    spark = conversations.sparkSession
    prepare(spark)
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    keys = even_keys(partitions(spark))
    to = F.element_at(F.array(*[F.lit(k) for k in keys]), (F.pmod(F.xxhash64("conv_id"), F.lit(len(keys))) + 1).cast("int"))
    sent = own.repartition(len(keys), to).sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return sent.mapInArrow(_format(path, outputs), DIGESTS + OUTPUTS * outputs)
