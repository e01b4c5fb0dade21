"""Token counts by field and section, from one encoding of the whole document.

A document is its fields in order, each but the last followed by a separator; a field is cut into sections after every
line feed. Sections so cover the document without gap or overlap, and a separator belongs to the section that it ends. The
document is encoded once, as a model would read it. Ids of a byte-level tokenizer map to byte and then to character spans
by the lengths of their pieces; spans and sections are joined as sorted intervals. A token inside one section counts for
it. A token across a boundary counts once, for the section that holds most of its characters, for the earlier of two with
equally many. Counts of a document's sections therefore add up to its number of tokens.

Both sides of the join belong to one document, so nothing is shuffled. Cases: null fields are empty; an empty field is one
empty section without tokens; a text that ends in a line feed has no empty section behind it; rows are kept apart, so
repeated and null ids are attributed row by row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.token_ids import piece_bytes, read_definition, shared_encoder

RESULT = "doc_id long, field string, section int, start long, end long, n_tokens long, n_crossing long"


def sections(values: list[str], by_line: bool, separator: str = "\n") -> tuple[str, list[int], list[int], list[int]]:
    """(document, field of every section, its number inside the field, its end in characters)."""
    fields, numbers, ends, at = [], [], [], 0
    for k, value in enumerate(values):
        value += separator if k < len(values) - 1 else ""
        lines = value.split("\n") if by_line else [value]
        parts = [x + "\n" for x in lines[:-1]] + lines[-1:] if by_line else lines
        if len(parts) > 1 and not parts[-1]:
            parts.pop()
        for n, part in enumerate(parts):
            at += len(part)
            fields.append(k), numbers.append(n), ends.append(at)
    return separator.join(values), fields, numbers, ends


def allocate(token_ends: np.ndarray, ends: np.ndarray, document: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) per section. ``token_ends``: in bytes; ``ends``: of sections, in characters."""
    if not len(token_ends):
        return np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
    character = np.cumsum((np.frombuffer(document, np.uint8) & 0xC0) != 0x80) - 1  # of each byte
    starts = np.r_[0, token_ends[:-1]]
    low, high = character[starts], character[token_ends - 1] + 1
    first = np.searchsorted(ends, low, side="right")
    last = np.searchsorted(ends, high - 1, side="right")
    owner, crosses = first.copy(), first != last
    for t in np.flatnonzero(crosses):
        inside = np.arange(first[t], last[t] + 1)
        begins = np.where(inside > 0, ends[inside - 1], 0)
        share = np.minimum(ends[inside], high[t]) - np.maximum(begins, low[t])
        owner[t] = inside[share.argmax()]
    return np.bincount(owner, minlength=len(ends)), np.bincount(owner[crosses], minlength=len(ends))


def attribute(docs: DataFrame, tokenizer: str, fields: list[str], by_line: bool = True, separator: str = "\n") -> DataFrame:
    """One row per section: doc_id, field, section (from 0 in each field), start and end in characters of the document,
    n_tokens, and n_crossing of them that reach into another section."""
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = shared_encoder(definition.value), piece_bytes(definition.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column(0)
                cut = [sections(list(v), by_line, separator) for v in zip(*(c.to_pylist() for c in part.columns[1:]), strict=True)]
                rows, columns = [], [[], [], [], []]
                for k, (raw, (document, which, numbers, ends)) in enumerate(
                    zip(encoder.encode([c[0] for c in cut]), cut, strict=True)
                ):
                    edge = np.array(ends, dtype=np.int64)
                    tokens, crossing = allocate(np.cumsum(lengths[np.frombuffer(raw, "<u2")]), edge, document.encode())
                    rows.append(np.full(len(ends), k))
                    columns[0] += which
                    columns[1] += numbers
                    columns[2].append(np.stack([np.r_[0, edge[:-1]], edge]))
                    columns[3].append(np.stack([tokens, crossing]))
                if not rows:
                    continue
                spans, counts = np.concatenate(columns[2], axis=1), np.concatenate(columns[3], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.concatenate(rows))), pa.array([fields[k] for k in columns[0]]),
                        pa.array(columns[1], pa.int32()), *map(pa.array, (*spans, *counts)),
                    ],
                    names=[c.split()[0] for c in RESULT.split(", ")],
                )

    texts = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"_{k}") for k, f in enumerate(fields)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *texts).mapInArrow(run, RESULT)
