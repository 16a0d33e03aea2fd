"""Chat formatting at token level.

Each text is encoded alone and the template's control strings are spliced in as reserved ids
above the vocabulary, so no content can ever produce one. The loss mask is the running sum of
+1 where a trained text begins and -1 where it ends. The same conversation is also written as
a string; there, a control string inside content gets an escape sign after its first
character, and one that already has such signs gets one more, so nothing is lost.

    <s>[INST]user text[/INST]assistant text</s>[ROLE]system[/ROLE]its text</s>

Turns of one conversation are put together as a sorted stream: a row holds whole turns up to
ROW_TOKENS tokens, and a conversation that needs more has further rows (``part``), so not even
one that holds a third of all turns is ever in memory at once.

Defined results: null texts and roles are empty; turns go by number, ties by role, then text,
null numbers first; repeated rows are turns of their own; rows without a conversation id form
one conversation without id; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidecast.llm.common import chunks, kept_in_worker, prepare, texts_of
from tidecast.llm.tokens import TO_CHARACTERS, encoder
from tidecast.session import ship_package

ROW_TOKENS = 1 << 16
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
BEGIN, END, USER, USER_END, ROLE, ROLE_END = range(6)
ESCAPE = "\\"
_RAW = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROLS))


def escape(text: str) -> str:
    """No control string is left in the result."""
    return _RAW.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str) -> str:
    return _RAW.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == ESCAPE else m[0], text)


@dataclass
class Turn:
    """A formatted turn: its ids, where trained text begins and ends in them, its string."""

    ids: np.ndarray
    trained: tuple[int, int]
    text: str


class ChatCoder:
    """Formats turns for one byte-level vocabulary and reads them back."""

    def __init__(self, path: str):
        self.words = encoder(path, special_is_text=True)
        vocabulary = self.words.library.get_vocab(with_added_tokens=True)
        self.first_control = max(vocabulary.values()) + 1
        byte_of = {c: b for b, c in TO_CHARACTERS.items()}
        self.bytes_of: list[bytes] = [b""] * self.first_control
        for text, i in vocabulary.items():
            known = all(c in byte_of for c in text)
            self.bytes_of[i] = bytes(byte_of[c] for c in text) if known else text.encode()

    def control(self, kind: int) -> np.ndarray:
        return np.array([self.first_control + kind], np.uint32)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.words.encode(text), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode()

    def turn(self, role: str, text: str) -> Turn:
        text = escape(text)
        content = self.encode(text)
        if role == "user":
            ids = [self.control(USER), content, self.control(USER_END)]
            return Turn(np.concatenate(ids), (0, 0), CONTROLS[USER] + text + CONTROLS[USER_END])
        if role == "assistant":
            ids = [content, self.control(END)]
            return Turn(np.concatenate(ids), (0, len(content)), text + CONTROLS[END])
        name = escape(role)
        ids = [self.control(ROLE), self.encode(name), self.control(ROLE_END), content, self.control(END)]
        head = CONTROLS[ROLE] + name + CONTROLS[ROLE_END]
        return Turn(np.concatenate(ids), (0, 0), head + text + CONTROLS[END])

    def read_turns(self, ids: np.ndarray) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn in a row's ids."""
        at = np.flatnonzero(ids >= self.first_control).tolist()
        low, role = 0, "assistant"
        for k in at:
            kind = int(ids[k]) - self.first_control
            part = unescape(self.decode(ids[low:k]))
            if kind == USER:
                role = "user"
            elif kind == ROLE_END:
                role = part
            elif kind in (END, USER_END):
                yield role, part
                role = "assistant"
            low = k + 1

    def read_trained(self, ids: np.ndarray, mask: np.ndarray) -> Iterator[str]:
        """The texts under the mask, one for each run of it."""
        edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
        for low, high in edges.reshape(-1, 2).tolist():
            yield unescape(self.decode(ids[low:high]))


_coders: dict[str, ChatCoder] = kept_in_worker()


def chat_coder(path: str) -> ChatCoder:
    if path not in _coders:
        _coders[path] = ChatCoder(path)
    return _coders[path]


TURNS = "conv_id long, turn long, role string, text string, ids binary, trained int, formatted string"
ROWS = "conv_id long, part int, n_turns int, ids array<int>, loss_mask array<tinyint>, formatted string"


def format_conversations(
    conversations: DataFrame,
    path: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv_id, part, n_turns, ids, loss_mask, formatted: the turns' encoding is spread over all
    rows first, then each conversation's turns are put together in order."""
    ship_package(prepare(conversations.sparkSession))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = chat_coder(path)
        for batch in chunks(batches, "text"):
            roles, texts = texts_of(batch.column("role")), texts_of(batch.column("text"))
            turns = [own.turn(r, t) for r, t in zip(roles, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([t.ids.astype("<u4").tobytes() for t in turns], pa.binary()),
                    pa.array([t.trained[1] for t in turns], pa.int32()),
                    pa.array([t.text for t in turns], pa.string()),
                ],
                names=[part.split()[0] for part in TURNS.split(", ")],
            )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = chat_coder(path)
        held: list[dict] = []
        size, part, last = 0, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                conv = (row["conv_id"],)
                if held and (conv != last or size >= ROW_TOKENS):
                    yield put_together(own, held, part)
                    held, size, part = [], 0, part + 1
                if conv != last:
                    last, part = conv, 0
                held.append(row)
                size += len(row["ids"]) // 4
        if held:
            yield put_together(own, held, part)

    slim = conversations.selectExpr(
        f"cast(`{conv_id}` as long) conv_id",
        f"cast(`{turn}` as long) turn",
        f"`{role}` role",
        f"`{text}` text",
    )
    turns = slim.mapInArrow(encode, TURNS)
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.drop("turn", "role", "text").mapInArrow(assemble, ROWS)


def put_together(own: ChatCoder, turns: list[dict], part: int) -> pa.RecordBatch:
    """One row of whole turns; the first part of a conversation begins with its begin sign."""
    lead = [] if part else [own.control(BEGIN)]
    pieces = lead + [np.frombuffer(t["ids"], "<u4") for t in turns]
    starts = np.cumsum([0, *[len(p) for p in pieces]])[len(lead) : -1]
    ids = np.concatenate(pieces)
    steps = np.zeros(len(ids) + 1, np.int8)
    lengths = np.array([t["trained"] for t in turns])
    np.add.at(steps, starts, (lengths > 0).astype(np.int8))
    np.subtract.at(steps, starts + lengths, (lengths > 0).astype(np.int8))
    text = "" if part else CONTROLS[BEGIN]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([turns[0]["conv_id"]], pa.int64()),
            pa.array([part], pa.int32()),
            pa.array([len(turns)], pa.int32()),
            pa.array([ids.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([np.cumsum(steps)[:-1].astype(np.int8)], pa.list_(pa.int8())),
            pa.array([text + "".join(t["formatted"] for t in turns)], pa.string()),
        ],
        names=["conv_id", "part", "n_turns", "ids", "loss_mask", "formatted"],
    )


SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """Digests of what the formatted rows hold, read from their ids and masks as a stream."""
    ship_package(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now = chat_coder(path), None
        done: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] == 0:
                    done += [now.row()] if now else []
                    now = Reading(row["conv_id"])
                now.add(own, row)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, SUMMARY_SCHEMA)
                done = []
        done += [now.row()] if now else []
        if done:
            yield pa.RecordBatch.from_pylist(done, SUMMARY_SCHEMA)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(run, SUMMARY)


SUMMARY_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


class Reading:
    """What has been read of one conversation so far."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, own: ChatCoder, row: dict) -> None:
        ids, mask = np.array(row["ids"], np.int64), np.array(row["loss_mask"])
        for role, text in own.read_turns(ids):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for text in own.read_trained(ids, mask):
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(row["formatted"])

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
        }
