"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string. It is rendered for successive prefixes of a
conversation; what an output adds to the one before is the span of the new turn, and an output that
does not begin with the one before rewrites history. Inside a turn's span, the text's own span is where two
renderings with different stand-in texts begin and stop to differ.

A conversation is streamed in order of its turns. At most ``window`` turns are rendered together: the window
slides, and each slide is checked to give the same last turn as the longer prefix did.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdcast.llm.common import columns_of, numbered

Turn = tuple[str, str]                                   # role, text
Template = Callable[[list[Turn]], str]

OPEN, MIDDLE, CLOSE = "<turn ", ">\n", "\n</turn>\n"


def escape(text: str) -> str:
    """Reversible: afterwards no < is left but after a backslash, so no control string can occur."""
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    out, at = [], 0
    while True:
        i = text.find("\\", at)
        if i < 0 or i + 1 >= len(text):
            return "".join([*out, text[at:]])
        out += [text[at:i], text[i + 1]]
        at = i + 2


def tagged(turns: list[Turn]) -> str:
    """The built-in template."""
    return "".join(f"{OPEN}{escape(role).replace(MIDDLE[0], chr(92) + MIDDLE[0])}{MIDDLE}{escape(text)}{CLOSE}" for role, text in turns)


def parse(formatted: str) -> Iterator[Turn]:
    """Turns read back from the output of ``tagged``."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        middle = formatted.index(MIDDLE, at)
        while (middle - len(formatted[:middle].rstrip("\\"))) % 2:
            middle = formatted.index(MIDDLE, middle + 1)
        close = formatted.index(CLOSE, middle + len(MIDDLE) - 1)
        yield unescape(formatted[at + len(OPEN):middle]), unescape(formatted[middle + len(MIDDLE):close])
        at = close + len(CLOSE)


@dataclass
class Span:
    piece: str                                           # what the turn adds to the output
    text: tuple[int, int]                                # where its text lies in the piece
    rewrites: bool


class Renderer:
    """Feeds one conversation's turns to a template, keeping at most ``window`` of them."""

    def __init__(self, template: Template, window: int = 32):
        self.template, self.window = template, window
        self.turns: list[Turn] = []
        self.output = ""

    def add(self, turn: Turn) -> Span:
        before, turns = self.output, [*self.turns, turn]
        after = self.template(turns)
        rewrites = not after.startswith(before)
        piece = after if rewrites else after[len(before):]
        start, end = self._text_span(turns, after)
        shift = len(after) - len(piece)
        self.turns, self.output = turns, after
        if len(turns) >= self.window:
            short = turns[-1:]
            alone, joined = self.template(turns[-2:-1]), self.template(turns[-2:])
            if joined.startswith(alone) and joined[len(alone):] == piece:    # the template looks at no more than the turn itself
                self.turns, self.output = short, self.template(short)
            else:
                self.window *= 2
        return Span(piece, (max(0, start - shift), max(0, end - shift)), rewrites)

    def _text_span(self, turns: list[Turn], whole: str) -> tuple[int, int]:
        """The turn's text in the whole output: two stand-ins without a common first or last character bound it."""
        role = turns[-1][0]
        one, two = (self.template([*turns[:-1], (role, x)]) for x in ("a", "b"))
        start = next((i for i, (x, y) in enumerate(zip(one, two, strict=False)) if x != y), len(one))
        return start, len(whole) - (len(one) - start - 1)


def format_chats(conversations: DataFrame, template: Template = tagged, window: int = 32) -> DataFrame:
    """Rows conv_id, place (from 0), turn, role, piece, text_start, text_end, learn, rewrites, in order within partitions.

    A conversation's pieces in order are its formatted text; ``learn`` marks assistant turns, whose
    text lies at text_start to text_end of the piece. Null roles and texts count as empty. Repeated rows, and rows with
    equal or null turn numbers, are turns each, ordered by turn (null first), role and text. A null conv_id is a
    conversation of its own. A conversation is sorted by Spark and streamed, never held whole.
    """
    at = {n: f"_{conversations.columns.index(n)}" for n in ("conv_id", "turn", "role", "text")}
    rows = numbered(conversations).select(F.col(at["conv_id"]).cast("long").alias("conv_id"), F.col(at["turn"]).cast("long").alias("turn"),
                                          *[F.coalesce(F.col(at[n]), F.lit("")).alias(n) for n in ("role", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, renderer, place = object(), None, 0
        for convs, turns, roles, texts in columns_of(batches, ("conv_id", "turn", "role", "text")):
            out = []
            for conv, turn, role, text in zip(convs, turns, roles, texts, strict=True):
                if renderer is None or conv != current:
                    current, renderer, place = conv, Renderer(template, window), 0
                span = renderer.add((role, text))
                out.append((conv, place, turn, role, span.piece, *span.text, role == "assistant", span.rewrites))
                place += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["conv_id", "place", "turn", "role", "piece", "text_start", "text_end", "learn", "rewrites"])

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, place long, turn long, role string, piece string, text_start long, text_end long, "
                                   "learn boolean, rewrites boolean")


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from the pieces of ``format_chats`` under ``tagged``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None                                     # conv, turns, turn digest, loss characters, loss digest, characters

        def row():
            return (open_[0], open_[1], open_[2].hexdigest(), open_[3], open_[4].hexdigest(), open_[5], open_[6])

        def emit(rows):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewrites"])

        for batch in columns_of(batches, ("conv_id", "place", "piece", "text_start", "text_end", "learn", "rewrites")):
            done = []
            for conv, place, piece, start, end, learn, rewrites in zip(*batch, strict=True):
                if place == 0:
                    if open_ is not None:
                        done.append(row())
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text in parse(piece):
                    open_[1] += 1
                    open_[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if learn:
                    loss = unescape(piece[start:end])
                    open_[3] += len(loss)
                    open_[4].update(loss.encode("utf-8", "surrogatepass"))
                open_[5] += len(piece)
                open_[6] += rewrites
            yield emit(done)
        if open_ is not None:
            yield emit([row()])

    return pieces.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                  "formatted_chars long, n_rewrites long")
