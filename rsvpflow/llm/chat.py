"""Chat formatting with offset-aligned loss masks (operator 9).

A conversation is rendered whole, encoded once with offsets, and the sorted spans of its assistant turns are
intersected with the sorted token spans by binary search.  Turn markers are private control strings that the tokenizer
gets as special tokens, so no token straddles a marker; texts are escaped so that they can never spell one:

    <|turn|>role<|text|>text<|end|>     per turn, with "\\\\" for "\\" and "\\x3c|" for "<|" inside role and text

Defined cases: null text is empty, null role is the empty role; turns go by ``turn`` (nulls first), then role and
text, and repeated rows stay repeated turns; rows whose ``conv_id`` is null form one conversation; an empty table
gives an empty result; extra columns are ignored.  A conversation is one record of the output, so it is held whole;
no conversation is held with another.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rsvpflow.llm.batches import map_slices

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
FORMATTED = "conv_id long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(s: str | None) -> str:
    return (s or "").replace("\\", "\\\\").replace("<|", "\\x3c|")


def unescape(s: str) -> str:
    if "\\" not in s:
        return s
    return "\\".join(part.replace("\\x3c|", "<|") for part in s.split("\\\\"))


def render(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the [start, end) spans of its assistant texts, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns read back from a formatted conversation."""
    turns = []
    for piece in formatted.split(TURN)[1:]:
        role, _, rest = piece.partition(TEXT)
        turns.append((unescape(role), unescape(rest[:-len(END)])))
    return turns


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens inside a span.  Both sides are sorted, so each span takes two binary searches."""
    mask = np.zeros(len(starts), dtype=bool)
    for lo, hi in spans:
        a, b = np.searchsorted(starts, lo, side="left"), np.searchsorted(ends, hi, side="right")
        mask[a:b] = True
    return mask


def masked_text(formatted: str, starts, ends, mask) -> list[str]:
    """Contiguous runs of text under the mask (byte-level tokens of one character share its offsets)."""
    runs: list[list[int]] = []
    for s, e, m in zip(starts, ends, mask):
        if m:
            if runs and s <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], e)
            else:
                runs.append([s, e])
    return [formatted[a:b] for a, b in runs]


def _tokenizer(blob: str):
    from tokenizers import AddedToken, Tokenizer, processors

    tok = Tokenizer.from_str(blob)
    tok.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (TURN, TEXT, END)])
    tok.post_processor = processors.ByteLevel(trim_offsets=False)
    return tok


def _format(cols: dict, tok) -> dict:
    out = {k: [] for k in ("conv_id", "formatted", "ids", "starts", "ends", "loss_mask")}
    for conv, rows in zip(cols["conv_id"], cols["rows"]):
        text, spans = render([(r["role"], r["text"]) for r in rows])
        enc = tok.encode(text, add_special_tokens=False)
        offs = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)
        mask = loss_mask(offs[:, 0], offs[:, 1], spans)
        for k, v in zip(out, (conv, text, enc.ids, offs[:, 0].tolist(), offs[:, 1].tolist(), mask.tolist())):
            out[k].append(v)
    return out


def format_chat(conversations: DataFrame, tokenizer_json: str, chars: int = 1 << 20) -> DataFrame:
    """One row per conversation: formatted text, token ids, offsets in code points, loss mask.

    ``tokenizer_json`` is the path of a byte-level ``tokenizers`` file; its content (a few MB) goes to the tasks.
    """
    spark = conversations.sparkSession
    blob = spark.sparkContext.broadcast(Path(tokenizer_json).read_text(encoding="utf-8"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))
    return map_slices(convs, _format, FORMATTED, setup=lambda: _tokenizer(blob.value), chars=chars, rows=64)


def _digest(cols: dict, _) -> dict:
    out = {f.split()[0]: [] for f in DIGEST.split(", ")}
    for conv, text, starts, ends, mask in zip(*(cols[c] for c in ("conv_id", "formatted", "starts", "ends", "loss_mask"))):
        turns = parse(text)
        loss = "".join(unescape(run) for run in masked_text(text, starts, ends, mask))
        row = (conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
               len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
        for k, v in zip(out, row):
            out[k].append(v)
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of turns and loss text, read back from the formatted output alone."""
    return map_slices(formatted, _digest, DIGEST, rows=256)


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """All conversations and conversation -1, whose texts spell control strings of a common template."""
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
