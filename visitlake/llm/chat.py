"""Chat formatting with a loss mask over tokens.

A turn is written as an opening mark, its role, a separator, its text and a closing mark. Assistant turns stand between
`<s>` and `</s>`, all others between `[INST]` and `[/INST]`. Control strings inside roles and texts are
escaped by one backslash after their first character; strings that already hold backslashes there get
one more, so removing one from each brings the text back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
ASSISTANT = "assistant"

# Fixed values of the template: opening and closing marks, separator, and the vocabulary's own end mark.
ASSISTANT_MARKS = ("<s>", "</s>")
OTHER_MARKS = ("[INST]", "[/INST]")
SEPARATOR = "<|text|>"
CONTROLS = (*ASSISTANT_MARKS, *OTHER_MARKS, SEPARATOR, "<|endoftext|>")

_ANY = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPABLE = re.compile(rf"(?<=[<\[])(?=\\*(?:{_ANY}))")
_ESCAPED = re.compile(rf"(?<=[<\[])\\(?=\\*(?:{_ANY}))")
_TURN = re.compile(
    r"(<s>|\[INST\])(.*?)<\|text\|>(.*?)(</s>|\[/INST\])", re.DOTALL
)

FORMATTED = (
    "conv_id {id}, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"
)


def escape(text: str) -> str:
    """`text` without any control string; `unescape` is its inverse for every text.

    Which first character goes with which rest is not looked at: `[s>` is escaped like `<s>`, and both come back.
    """
    return _ESCAPABLE.sub(r"\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def render(roles: list[str], texts: list[str]) -> tuple[str, np.ndarray]:
    """The formatted conversation and the sorted (start, end) character spans of the assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in zip(roles, texts):
        opening, closing = ASSISTANT_MARKS if role == ASSISTANT else OTHER_MARKS
        head, body = f"{opening}{escape(role)}{SEPARATOR}", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, closing]
        at += len(head) + len(body) + len(closing)
    return "".join(parts), np.array(spans, dtype=np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    return [(unescape(m[2]), unescape(m[3])) for m in _TURN.finditer(formatted)]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether each token (sorted offsets) overlaps a span (sorted, apart), by binary search of its place."""
    if not len(spans):
        return np.zeros(len(starts), dtype=bool)
    after = np.searchsorted(spans[:, 1], starts, side="right")  # the first span that ends after the token starts
    begin = np.append(spans[:, 0], np.iinfo(np.int64).max)[after]
    return (begin < ends) & (starts < ends)


def masked_regions(starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[tuple[int, int]]:
    """Character regions under the mask; tokens that touch or share a character form one region."""
    s, e = starts[mask], ends[mask]
    if not len(s):
        return []
    first = np.append(True, s[1:] > np.maximum.accumulate(e)[:-1])
    last = np.append(np.flatnonzero(first)[1:] - 1, len(s) - 1)
    return list(zip(s[first].tolist(), np.maximum.accumulate(e)[last].tolist()))


@cache
def _tokenizer(path: str):
    """Tokenizer whose marks are tokens of their own, so that no token reaches across the border of a text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens(list(CONTROLS))
    return tokenizer


_ROWS = 128  # conversations whose tokens are held at once


def _formatter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                rendered = [render([t["role"] for t in turns], [t["text"] for t in turns]) for turns in batch.column(1).to_pylist()]
                encoded = tokenizer.encode_batch([text for text, _ in rendered], add_special_tokens=False)
                offsets = [np.array(e.offsets, dtype=np.int32).reshape(-1, 2) for e in encoded]
                masks = [loss_mask(o[:, 0], o[:, 1], spans) for o, (_, spans) in zip(offsets, rendered)]
                ends = pa.array(np.cumsum([0, *map(len, offsets)]), pa.int32())
                flat = np.concatenate(offsets)
                lists = {
                    "token_ids": np.concatenate([np.array(e.ids, dtype=np.int32) for e in encoded]),
                    "token_starts": flat[:, 0], "token_ends": flat[:, 1], "loss_mask": np.concatenate(masks),
                }
                yield pa.RecordBatch.from_pydict({
                    "conv_id": batch.column(0), "formatted": [text for text, _ in rendered],
                    **{name: pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(x))) for name, x in lists.items()},
                })

    return run


def format_conversations(turns: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per conversation of `turns` (conv_id, turn, role, text): formatted text, tokens, offsets and loss mask.

    Turns are put in order of `turn` (null first), ties by role and text; repeated rows are turns of their own. Null roles
    and texts count as empty, a null conv_id is a conversation too, an empty table gives an empty one.
    Offsets count code points, and a conversation is encoded once, as a whole, in one row; so the longest
    conversation must fit a task. `tokenizer` is a path every executor reads.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    bare = grouped.select("conv_id", F.expr("transform(turns, t -> struct(t.role, t.text))").alias("turns"))
    return bare.mapInArrow(_formatter(tokenizer), FORMATTED.format(id=turns.schema["conv_id"].dataType.simpleString()))
