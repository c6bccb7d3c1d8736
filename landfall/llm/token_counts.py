"""Token counts by section: whole documents are encoded once, tokens given to sections.

A document is its fields joined by a line feed; a section is a line of a field with its
line feed. Tokens of a byte-level BPE tile the document's bytes, so their spans are sums of
their lengths; an interval join of the sorted token and section bounds gives each section
its tokens. A token that crosses a boundary goes to the section with most of its
characters, of equal ones to the earlier; a token in which no character begins goes with
its first byte.

Null fields count as empty; an empty field is one section without characters, whose only
token can be the line feed after it. Rows are counted one for one, copies alike.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame

from landfall.llm.text import map_rows

SCHEMA = ("doc_id long, field string, part int, begin long, end long, n_tokens long, "
          "n_crossing long")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def sections(fields: Sequence[tuple[str, str]]) -> tuple[bytes, list[tuple[str, int]], np.ndarray]:
    """The document, (field, part) of each section, and the byte where each begins."""
    raw = "\n".join(text for _, text in fields).encode()
    names: list[tuple[str, int]] = []
    begins: list[int] = []
    at = 0
    for name, text in fields:
        part = text.encode()
        lines = part.split(b"\n")
        for k, line in enumerate(lines):
            # The empty end after a closing line feed is no section of its own.
            if k and k == len(lines) - 1 and not line:
                continue
            names.append((name, k))
            begins.append(at)
            at += len(line) + (k < len(lines) - 1)
        at += 1  # the line feed between fields
    return raw, names, np.array(begins, np.int64)


def allocate(raw: bytes, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of each section, from the tokens' lengths in bytes."""
    stops = np.cumsum(lengths)
    starts = stops - lengths
    data = np.frombuffer(raw, np.uint8)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    first = np.searchsorted(begins, starts, "right") - 1
    last = np.searchsorted(begins, stops - 1, "right") - 1
    owner = first.copy()
    crossing = np.flatnonzero(last > first)
    bounds = np.append(begins, len(raw))
    for t in crossing.tolist():
        inner = range(first[t], last[t] + 1)
        share = [int(chars[min(bounds[s + 1], stops[t])] - chars[max(bounds[s], starts[t])])
                 for s in inner]
        owner[t] = first[t] + share.index(max(share))
    n = len(begins)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def attribute(docs: DataFrame, path: str, pattern: str, fields: Sequence[str] = ("text",)
              ) -> DataFrame:
    """doc_id, field, part (line number), begin and end in characters, and token counts."""
    names = list(fields)
    # The vocabulary has a fixed size.
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def rows(records: Iterator[dict]) -> Iterator[tuple]:
        import tiktoken

        table = ranks.value
        encoder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=table,
                                    special_tokens={})
        size = np.zeros(max(table.values()) + 1, np.int64)
        for piece, rank in table.items():
            size[rank] = len(piece)
        for record in records:
            raw, parts, begins = sections([(n, record[n] or "") for n in names])
            ids = np.asarray(encoder.encode_ordinary(raw.decode()), np.int64)
            tokens, crossing = allocate(raw, begins, size[ids])
            lead = np.concatenate(
                [[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
            edges = lead[np.append(begins, len(raw))].tolist()
            for k, (name, part) in enumerate(parts):
                yield (record["doc_id"], name, part, edges[k], edges[k + 1],
                       int(tokens[k]), int(crossing[k]))

    keep = ["doc_id", *[n for n in names if n != "doc_id"]]
    return map_rows(docs.select(*keep), SCHEMA, rows)
