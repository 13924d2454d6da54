"""Chat formatting of typed content parts, with reversible escapes and a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: First characters of control strings, of this template and of others in use.
_CONTROL = re.compile(r"<(?=\|)|\[(?=/?INST\])|<(?=/?s>)|<(?=</?SYS>>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|(image|audio|document|other):(\d+)\|>")

PARTS = "array<struct<type:string,text:string,ref:string,tokens:int>>"
SEGMENT = (
    "conv_id {id}, seq long, role string, formatted string, start long, loss_start long, loss_end long, "
    "attachments array<struct<index:int,type:string,ref:string,tokens:int,position:long>>, n_tokens long"
)
#: Tokens a placeholder stands for where the part doesn't say.
EXPANDED = {"image": 576, "audio": 750, "document": 1024, "other": 1}


def escape(text: str, role: bool = False) -> str:
    """Doubles backslashes and puts one behind the first character of every control string."""
    text = _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))
    return text.replace("\n", "\\\n") if role else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flattener:
    """Visits the parts of one turn and keeps text, attachments and token counts in order."""

    def __init__(self, first_index: int):
        self.pieces: list[str] = []
        self.attachments: list[dict] = []
        self.length = 0
        self.n_tokens = 0
        self.index = first_index

    def visit(self, part: dict | None) -> None:
        if part is None:
            return
        kind = part["type"] if part["type"] in ("text", "image", "audio", "document") else "other"
        getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part: dict) -> None:
        text = part["text"] or ""
        self._add(escape(text))
        self.n_tokens += len(text.encode().split()) if part["tokens"] is None else part["tokens"]

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part)

    def _attach(self, kind: str, part: dict) -> None:
        tokens = EXPANDED[kind] if part["tokens"] is None else part["tokens"]
        self.attachments.append(
            {"index": self.index, "type": kind, "ref": part["ref"], "tokens": tokens, "position": self.length}
        )
        self._add(f"<|{kind}:{self.index}|>")
        self.index += 1
        self.n_tokens += tokens

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted string; placeholders stay in the text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def format_chats(messages: DataFrame) -> DataFrame:
    """Formats conversations; one row per turn, so a conversation of any length fits.

    messages: conv_id, turn, role, parts (PARTS); other columns are not read. Turns are ordered by turn,
    then role and parts; repeated rows are repeated turns. Null roles and texts are empty, null parts or
    turns too (null turns first); null conv_ids are one conversation. A part of unknown type gets a
    placeholder of its own kind. Empty tables give no rows.

    Returns conv_id, seq, role, formatted (the segment), start (its code point in the conversation's
    string), loss_start and loss_end (the assistant text in that string, else null), attachments
    (index, type, ref, tokens, position in the string) and n_tokens (words, or what the part says, plus
    expanded attachments). Segments in order of seq, joined by nothing, are the conversation's string.
    Tasks stream over sorted rows and hold one Arrow batch.
    """
    id_type = messages.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seq, at, index = object(), 0, 0, 0
        for batch in batches:
            rows = []
            for conv_id, role, parts in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != current:
                    current, seq, at, index = conv_id, 0, 0, 0
                flat = Flattener(index)
                for part in parts or ():
                    flat.visit(part)
                head = f"{START}{escape(role or '', role=True)}\n"
                text = "".join(flat.pieces)
                begin = at + len(head)
                for a in flat.attachments:
                    a["position"] += begin
                loss = (begin, begin + len(text)) if role == "assistant" else (None, None)
                formatted = f"{head}{text}{END}"
                rows.append((conv_id, seq, role, formatted, at, *loss, flat.attachments, flat.n_tokens))
                at += len(formatted)
                seq, index = seq + 1, flat.index
            columns = list(zip(*rows)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    shape = _parse_datatype_string(SEGMENT.format(id=id_type))
    schema = to_arrow_schema(shape)
    ordered = messages.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "parts")
    return ordered.select("conv_id", "role", "parts").mapInArrow(run, shape)


def digests(segments: DataFrame) -> DataFrame:
    """One row per conversation, read back from segments in the order `format_chats` gives them.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars, loss_sha256
    (unescaped text under the loss mask), formatted_chars, n_tokens, n_attachments.
    """
    id_type = segments.schema["conv_id"].dataType.simpleString()
    shape = (
        f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_tokens long, n_attachments long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        fields = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_attachments")

        def closed(s):
            return {**s, "turns_sha256": s["turns_sha256"].hexdigest(), "loss_sha256": s["loss_sha256"].hexdigest()}

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], kinds[f]) for f in fields], list(fields))

        for batch in batches:
            rows = []
            for conv_id, formatted, start, lo, hi, tokens, n in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or start == 0:
                    if state is not None:
                        rows.append(closed(state))
                    state = dict.fromkeys(fields, 0) | {"conv_id": conv_id, "turns_sha256": hashlib.sha256(), "loss_sha256": hashlib.sha256()}
                for role, text in read_turns(formatted):
                    state["turns_sha256"].update(f"{role}\n{text}\n".encode())
                    state["n_turns"] += 1
                if lo is not None:
                    loss = unescape(formatted[lo - start : hi - start])
                    state["loss_sha256"].update(loss.encode())
                    state["loss_chars"] += len(loss)
                state["formatted_chars"] += len(formatted)
                state["n_tokens"] += tokens
                state["n_attachments"] += n
            yield table(rows)
        if state is not None:
            yield table([closed(state)])

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {f: pa.int64() for f in ("n_turns", "loss_chars", "formatted_chars", "n_tokens", "n_attachments")}
    kinds |= {"turns_sha256": pa.string(), "loss_sha256": pa.string()}
    kinds["conv_id"] = to_arrow_type(segments.schema["conv_id"].dataType)
    columns = ["conv_id", "formatted", "start", "loss_start", "loss_end", "n_tokens", F.size("attachments").alias("n")]
    return segments.select(*columns).mapInArrow(run, shape)


def text_messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as messages of one text part."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("tokens"),
    )
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))
