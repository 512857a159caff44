"""Operator 9: token counts by overlap resynchronisation.

A text's pieces never cross a *stable boundary*: a place where a character other than a
space is followed by a space.  This is proven from the vocabulary (:func:`spaces_only_lead`):
no piece holds a space after another character, merges only ever build pieces of the
vocabulary, so no merge joins the two sides and neither side influences the other.

Texts longer than ``chunk_chars`` are encoded in overlapping chunks with piece offsets.
Two neighbouring chunks are spliced at the first stable boundary inside their overlap at
which both encodings start a piece.  If there is none, the overlap doubles, backwards as
far as the last splice and then forwards, up to the rest of the text.  Shorter texts are
cut at all their stable boundaries and each distinct segment is encoded once per task.

Counts equal the library's for the whole text (no begin, end or special tokens).

Cases: null and empty texts have 0 bytes and 0 tokens; every input row gives one output
row, repeated rows and null ids too; other input columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK_CHARS = 1 << 15
OVERLAP = 256
CACHED_SEGMENTS, CACHED_CHARS = 400_000, 64
SPACE = "▁"  # the library writes a space so, and takes it for one in a text


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def spaces_only_lead(pieces: list[str]) -> bool:
    """The proof of stable boundaries: spaces occur in pieces only before all other characters."""
    return not any(SPACE in p.lstrip(SPACE) for p in pieces)


def stable(text: str, at: int) -> bool:
    return 0 < at < len(text) and text[at] == " " and text[at - 1] != " "


class SegmentCounts(dict):
    """Tokens of a segment (without its first space), encoded when first met."""

    def __init__(self, encode: Callable):
        super().__init__()
        self.encode = encode

    def __missing__(self, segment: str) -> int:
        n = len(self.encode(segment)) if segment else 1  # a space of its own
        if len(segment) <= CACHED_CHARS:
            if len(self) >= CACHED_SEGMENTS:
                self.clear()
            self[segment] = n
        return n


SEGMENT = re.compile(" ( *[^ ]+| *$)")


def count_short(text: str, counts: SegmentCounts) -> int:
    """Tokens of a text, as the sum over its segments."""
    if not text:
        return 0
    text = text.replace(SPACE, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return sum(counts[s] if s.strip(" ") else len(counts.encode(s)) if s else 1
                   for s in SEGMENT.findall(" " + text))
    return sum(map(counts.__getitem__, text.split(" ")))


def starts_of(encode_offsets: Callable, text: str, first: int, last: int) -> list[int]:
    """Where the pieces of text[first:last], encoded alone, start in the text."""
    return [first + b for b in encode_offsets(text[first:last])]


def count_long(text: str, encode_offsets: Callable, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP) -> int:
    """Tokens of a text from overlapping chunks, spliced where neighbours agree on a stable boundary."""
    text, n = text.replace(SPACE, " "), len(text)
    total, splice, first, last = 0, 0, 0, min(chunk, n)
    starts = starts_of(encode_offsets, text, first, last)
    while last < n:
        width, at = overlap, None
        while at is None:
            begin = max(splice, last - width)
            end = min(n, begin + max(chunk, 2 * width))
            ahead = starts_of(encode_offsets, text, begin, end)
            common = set(ahead)
            at = next((s for s in starts if s > begin and s > splice and s in common and stable(text, s)), None)
            if at is None:
                if begin > splice:
                    width *= 2  # further back
                else:
                    last = min(n, last + max(chunk, width))  # no agreement since the last splice: further on
                    starts = starts_of(encode_offsets, text, first, last)
                    if last == n:
                        return total + sum(s >= splice for s in starts)
        total += sum(splice <= s < at for s in starts)
        splice, first, last, starts = at, begin, end, ahead
    return total + sum(s >= splice for s in starts)


def token_counts(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit). Map-only.

    ``model_path`` names the tokenizer's file on every executor (default: the public file).
    """
    path = model_path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proven = spaces_only_lead([sp.id_to_piece(i) for i in range(sp.get_piece_size())])
        counts = SegmentCounts(sp.encode)

        def offsets(part: str) -> list[int]:
            return [begin for begin, _ in sp.encode(part, return_type="offset_mapping")["offsets"]]

        def count(text: str | None) -> int:
            if not text:
                return 0
            if not proven:  # another vocabulary: whole texts only
                return len(sp.encode(text))
            return count_long(text, offsets, chunk_chars, overlap) if len(text) > chunk_chars else count_short(text, counts)

        for batch in batches:
            n = pa.array([count(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                      F.col(text_col).alias("text"))
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
