"""Chat formatting with typed content parts.

A message's content is a list of typed parts (text, image, audio, document).  A visitor
walks the parts and flattens them, in order, into the text of the message: text parts are
escaped, the others become numbered placeholders ``<|image|>0<|/image|>``; it records each
attachment reference and how many tokens the placeholder expands to in the model's input.

The template is ``<|im_start|>ROLE\\nCONTENT<|im_end|>\\n`` per turn.  No text can forge a
control string: every ``<`` that is followed by any number of backslashes and ``|`` gets
one more backslash, which reading back removes again.

Turns are formatted one by one in parallel, wherever their conversation's other turns
are, and written as fragments keyed by conversation and turn.  Reading back streams the
fragments of a conversation in order, holding one fragment at a time, so a conversation
of any length needs constant memory.

Defined results
    * a null text or empty list of parts is an empty content, a null role an empty role;
    * turns are ordered by turn (nulls first), then role, then text; repeated rows are
      repeated turns;
    * a part of an unknown kind is recorded as an attachment of that kind, with the placeholder
      ``attachment`` and no tokens; a null or negative number in a size counts as 0;
    * an empty table gives no conversations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

START, END = "<|im_start|>", "<|im_end|>\n"
_TO_ESCAPE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")

FRAGMENT = ("conv_id long, turn long, tie string, fragment string, loss_from int, loss_to int, "
            "attachments array<struct<kind:string,ref:string,tokens:long>>, extra_tokens long")
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
          "loss_sha256 string, formatted_chars long, n_attachments long, extra_tokens long")


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    """As ``escape``, and without line breaks: the first one ends the role."""
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


@dataclass(frozen=True)
class Part:
    """One content part.  ``text`` for text parts; ``ref`` and a size for the others:
    image (width, height), audio (seconds), document (pages)."""
    kind: str
    text: str | None = None
    ref: str | None = None
    size: tuple[float, ...] = ()


@dataclass
class Flattener:
    """Visitor that flattens parts into content and records attachments."""
    patch: int = 28                 # image pixels per token, in each direction
    audio_tokens_per_s: float = 12.5
    page_tokens: int = 512
    attachments: list[tuple[str, str | None, int]] = field(default_factory=list)

    def visit(self, part: Part) -> str:
        return getattr(self, f"visit_{part.kind}", self.visit_other)(part)

    def visit_other(self, part: Part) -> str:
        """A part of a kind that has no visitor: an attachment without tokens of its own."""
        self.attachments.append((part.kind, part.ref, 0))
        return f"<|attachment|>{len(self.attachments) - 1}<|/attachment|>"

    def visit_text(self, part: Part) -> str:
        return escape(part.text or "")

    def visit_image(self, part: Part) -> str:
        w, h = (*part.size, 0, 0)[:2]
        return self._attach("image", part, max(1, -int(-w // self.patch) * -int(-h // self.patch)))

    def visit_audio(self, part: Part) -> str:
        seconds = (*part.size, 0)[0]
        return self._attach("audio", part, max(1, -int(-seconds * self.audio_tokens_per_s // 1)))

    def visit_document(self, part: Part) -> str:
        return self._attach("document", part, max(1, int((*part.size, 1)[0]) * self.page_tokens))

    def _attach(self, kind: str, part: Part, tokens: int) -> str:
        self.attachments.append((kind, part.ref, tokens))
        return f"<|{kind}|>{len(self.attachments) - 1}<|/{kind}|>"

    def flatten(self, parts: list[Part]) -> str:
        """Adjacent text parts are joined first: a control string cut in two is escaped too."""
        merged: list[Part] = []
        for p in parts:
            if p.kind == "text" and merged and merged[-1].kind == "text":
                p = Part("text", (merged.pop().text or "") + (p.text or ""))
            merged.append(p)
        return "".join(map(self.visit, merged))


def parts_of(content) -> list[Part]:
    """Parts of a cell: null, a plain text, or a list of rows (kind, text, ref, size)."""
    if content is None:
        return []
    if isinstance(content, str):
        return [Part("text", content)]
    return [Part(p["kind"] or "text", p.get("text"), p.get("ref"),
                 tuple(max(x or 0, 0) for x in p.get("size") or ()))
            for p in content if p is not None]


def format_turn(role: str | None, content, loss_roles: tuple[str, ...]) -> dict:
    """The fragment of one turn, its loss span (code points) and its attachments."""
    flat = Flattener()
    body = flat.flatten(parts_of(content))
    head = f"{START}{escape_role(role or '')}\n"
    span = (len(head), len(head) + len(body)) if role in loss_roles else (0, 0)
    return {"fragment": head + body + END, "loss_from": span[0], "loss_to": span[1],
            "attachments": [dict(zip(("kind", "ref", "tokens"), a)) for a in flat.attachments],
            "extra_tokens": sum(a[2] for a in flat.attachments)}


def parse_turn(fragment: str) -> tuple[str, str]:
    """Role and text of a formatted turn (placeholders stay as they stand)."""
    if not (fragment.startswith(START) and fragment.endswith(END)):
        raise ValueError("not a formatted turn")
    role, _, body = fragment[len(START):-len(END)].partition("\n")
    return unescape_role(role), unescape(body)


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",),
                         conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", content_col: str = "text") -> DataFrame:
    """One formatted fragment per turn; a narrow map, nothing is shuffled."""
    ship(turns.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        schema = pa.schema([
            ("conv_id", pa.int64()), ("turn", pa.int64()), ("tie", pa.string()),
            ("fragment", pa.string()), ("loss_from", pa.int32()), ("loss_to", pa.int32()),
            ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()),
                                                ("tokens", pa.int64())]))),
            ("extra_tokens", pa.int64())])
        for b in batches:
            rows = []
            for conv, turn, role, content in zip(*(c.to_pylist() for c in b.columns)):
                f = format_turn(role, content, loss_roles)
                rows.append({"conv_id": conv, "turn": turn, "tie": role, **f})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return (turns.select(F.col(conv_col).cast("long"), F.col(turn_col).cast("long"),
                         F.col(role_col), F.col(content_col))
            .mapInArrow(run, FRAGMENT))


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.attached = self.extra = 0

    def add(self, fragment: str, lo: int, hi: int, attachments: int, extra: int) -> None:
        role, text = parse_turn(fragment)
        self.turns.update(f"{role}\n{text}\n".encode())
        masked = unescape(fragment[lo:hi])
        self.loss.update(masked.encode())
        self.n += 1
        self.loss_chars += len(masked)
        self.chars += len(fragment)
        self.attached += attachments
        self.extra += extra

    def row(self) -> dict:
        return {"conv_id": self.conv, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(),
                "formatted_chars": self.chars, "n_attachments": self.attached,
                "extra_tokens": self.extra}


def digest_conversations(fragments: DataFrame) -> DataFrame:
    """Read formatted fragments back: one row per conversation with digests of its turns
    and of the text under the loss mask.

    A digest of a whole conversation is sequential by nature; the fragments of one
    conversation are therefore streamed through one task, sorted by Spark (which spills),
    and never gathered in memory.
    """
    ship(fragments.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        schema = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string()}[c.split()[1]])
                            for c in DIGEST.split(", ")])
        now: _Digest | None = None
        for b in batches:
            done = []
            for conv, fragment, lo, hi, attached, extra in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(fragment, lo, hi, attached, extra)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], schema=schema)

    n = int(fragments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (fragments.repartition(n, "conv_id")
            .sortWithinPartitions("conv_id", "turn", "tie", "fragment")
            .select("conv_id", "fragment", "loss_from", "loss_to",
                    F.size("attachments").alias("attached"), "extra_tokens")
            .mapInArrow(run, DIGEST))


def write_conversations(turns: DataFrame, **options) -> DataFrame:
    """Format, write to a shared folder, and return the written fragments."""
    return stored(format_conversations(turns, **options), "chat")
