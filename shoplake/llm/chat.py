"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only its text is trainable. A turn is written as

    ### <role>: <text></turn>\n

Control strings inside roles and texts are escaped reversibly: a backslash is
doubled, the third and each further ``#`` of a run, ``</turn>`` and, in roles, the
colon get a backslash, so neither a turn's head nor its end can occur inside a text.

Turns are shuffled once by conversation and sorted within the task; a task then
streams over its rows, holding one conversation's formatted prefix at a time, and
hands out examples in batches of bounded size. The output is as large as its
definition says: a conversation of k turns gives up to k examples that repeat their
prefix.

Defined results: a null text or role is the empty string; a null conv_id is one
conversation; turns are ordered by turn (null first), then role and text, and equal
rows stay separate turns; turns after the last assistant turn come as one more
example without a target, so no turn is lost; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import shipped

HEAD, END = "### ", "</turn>\n"
ASSISTANT = "assistant"
BATCH_CHARS = 4_000_000
EXAMPLES = "conv_id long, example int, n_turns int, text string, target_start int, target_end int"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_examples long")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*?)</turn>\n", re.S)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\") if "\\" in text else text
    text = re.sub(r"(?<=##)#", r"\\#", text) if "###" in text else text
    return text.replace("</turn>", "<\\/turn>") if "</turn>" in text else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text starts and ends in it."""
    head = f"{HEAD}{escape(role).replace(':', chr(92) + ':')}: "
    body = escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(conv_id, role, text, ends) of sorted rows; ``ends`` marks a conversation's last row."""
    last = None
    for pdf in batches:
        for conv, has, role, text in zip(pdf["conv_id"], pdf["has_id"], pdf["role"], pdf["text"], strict=True):
            key = int(conv) if has else None
            if last is not None:
                yield (*last, last[0] != key)
            last = (key, role, text)
    if last is not None:
        yield (*last, True)


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows, chars = [], 0
    prefix: list[str] = []
    n = k = at = 0
    for conv, role, text, ends in _conversations(batches):
        turn, a, b = format_turn(role, text)
        prefix.append(turn)
        n += 1
        if role == ASSISTANT or ends:
            if len(prefix) > 1:
                prefix = ["".join(prefix)]
            k += 1
            trained = role == ASSISTANT
            rows.append((conv, k, n, prefix[0], at + a if trained else -1, at + b if trained else -1))
            chars += len(prefix[0])
        at += len(turn)
        if ends:
            prefix, n, k, at = [], 0, 0, 0
        if chars >= BATCH_CHARS:
            yield _frame(rows, EXAMPLES)
            rows, chars = [], 0
    if rows:
        yield _frame(rows, EXAMPLES)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


def expand(turns: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 1), n_turns, text and the trainable span (or -1, -1).

    The examples of a conversation lie in one task, in order.
    """
    empty = F.lit("")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
                        F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    rows = rows.select(F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNotNull().alias("has_id"),
                       "role", "text")
    return shipped(rows).mapInPandas(_expand, EXAMPLES)


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = []
    now = None  # conv_id, last text, loss digest, loss chars, formatted chars, examples

    def close() -> tuple:
        conv, text, loss, chars, total, k = now
        turns = parse(text)
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode())
        return conv, len(turns), digest.hexdigest(), chars, loss.hexdigest(), total, k

    for pdf in batches:
        for conv, k, text, a, b in zip(pdf["conv_id"], pdf["example"], pdf["text"], pdf["target_start"],
                                       pdf["target_end"], strict=True):
            if k == 1:
                if now is not None:
                    rows.append(close())
                now = [None if pd.isna(conv) else int(conv), "", hashlib.sha256(), 0, 0, 0]
            target = unescape(text[a:b]) if a >= 0 else ""
            now[2].update(target.encode())
            now[1], now[3], now[4], now[5] = text, now[3] + len(target), now[4] + len(text), int(k)
        if rows:
            yield _frame(rows, DIGESTS)
            rows = []
    if now is not None:
        yield _frame([close()], DIGESTS)


def digests(examples: DataFrame) -> DataFrame:
    """What ``expand``'s rows hold, read back from their texts and spans, per conversation."""
    return shipped(examples).mapInPandas(_read_back, DIGESTS)
