"""Token counts per section from one encoding of the whole document.

A document is encoded once; the tokens' byte lengths give the span of each token,
and an interval join (a sorted search within the document) attributes tokens to
sections. A token that crosses a boundary is allotted by ``rule``:
``start`` - the section that holds its first byte; ``end`` - the one that holds its
last; ``most`` - the one that holds most of it, the earlier one on a tie. Sections
are consecutive and cover the text, so the counts add up to the document's.

Edge cases: null and empty texts have no tokens and one empty section; repeated
ids are separate rows.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from sieveline.llm import textscan

#: The sections of a document, in order.
SECTIONS = ("head", "body", "tail")
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranks(path: str) -> bytes:
    """The vocabulary file's bytes, read on the driver; 50k lines at most go to the executors."""
    with open(path, "rb") as f:
        return f.read()


@cache
def _encoder(raw: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    length = np.zeros(max(table.values()) + 1, np.int64)
    for piece, i in table.items():
        length[i] = len(piece)
    return tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=table, special_tokens={}), length


def spans(enc, length: np.ndarray, text: str) -> np.ndarray:
    """Byte ends of the tokens of a whole text."""
    ids = np.asarray(enc.encode_to_numpy(text) if hasattr(enc, "encode_to_numpy") else enc.encode_ordinary(text), np.int64)
    return np.cumsum(length[ids])


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str = "start") -> np.ndarray:
    """Tokens of each section; ``bounds``: the sections' byte ends, rising, the last one the text's."""
    if rule not in ("start", "end", "most"):
        raise ValueError(rule)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    if rule == "start":
        of = np.searchsorted(bounds, starts, "right")
    elif rule == "end":
        of = np.searchsorted(bounds, ends - 1, "right")
    else:
        a, b = np.searchsorted(bounds, starts, "right"), np.searchsorted(bounds, ends - 1, "right")
        of = a.copy()
        for i in np.flatnonzero(a != b):
            inner = np.clip(np.concatenate([[starts[i]], bounds[a[i] : b[i]], [ends[i]]]), starts[i], ends[i])
            of[i] = a[i] + int(np.argmax(np.diff(inner)))
    return np.bincount(of, minlength=len(bounds))[: len(bounds)]


def line_sections(raw: bytes) -> np.ndarray:
    """Byte ends of head (the first line with its line feed), body, tail (the last line, if there are two)."""
    first = raw.find(b"\n") + 1 or len(raw)
    last = max(first, raw.rfind(b"\n") + 1) if first < len(raw) else len(raw)
    return np.array([first, last, len(raw)])


def count_sections(docs: DataFrame, vocabulary: str, rule: str = "start") -> DataFrame:
    """doc_id, section, section_bytes, n_tokens, doc_tokens, crossing: three rows for each document."""
    raw = ranks(vocabulary)
    held = docs.sparkSession.sparkContext.broadcast(raw)

    def run(batches):
        enc, length = _encoder(held.value)
        for batch, _, _ in textscan.blocks(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                data = text.encode()
                ends, bounds = spans(enc, length, text), line_sections(data)
                n = attribute(ends, bounds, rule)
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                crossing = int((np.searchsorted(bounds, starts, "right") != np.searchsorted(bounds, ends - 1, "right")).sum())
                size = np.diff(np.concatenate([[0], bounds]))
                rows += [(doc_id, s, int(size[k]), int(n[k]), len(ends), crossing) for k, s in enumerate(SECTIONS)]
            out = pd.DataFrame(rows, columns=["doc_id", "section", "section_bytes", "n_tokens", "doc_tokens", "crossing"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield pa.RecordBatch.from_pandas(out, preserve_index=False, schema=pa.schema([("doc_id", pa.int64()), ("section", pa.string()), *((c, pa.int64()) for c in out.columns[2:])]))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, section string, section_bytes long, n_tokens long, doc_tokens long, crossing long")
