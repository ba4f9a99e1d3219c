"""Operator 9: SentencePiece encoding and decoding through a distinct-chunk table.

The text is written with whitespace markers (one in front, one per space) and
cut before every run of markers. When no piece of the vocabulary has a marker
after another character, no merge can cross such a cut, so the segmentation of
a text is the concatenation of the segmentations of its chunks. Each distinct
chunk is segmented once with the sentencepiece library and kept in a table;
a document's ids are the table's entries joined by position, and its decoded
text likewise. The model is checked for the properties this rests on
(identity normalisation, marker in front, no marker inside or at the end of a
piece, no user-defined pieces); a model without them is rejected.

The table lives in the Python worker of a task and is cleared before a text when
it exceeds ``TABLE_ENTRIES`` entries or ``TABLE_BYTES`` (texts without blanks are
one chunk each), and at the end of the task. A table joined across the cluster by (chunk, position) would
shuffle one row per word, several times the input, to save a segmentation
that costs microseconds; see the README for figures. There is no shuffle.

Defined cases: a null or empty text has the begin and end ids only; texts of
any length are encoded whole; repeated rows repeat; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import documents, prepare_python, text_of

MARKER = "▁"
MODEL = "piece_bpe_32k.model"
TABLE_ENTRIES = 150_000
TABLE_BYTES = 48 << 20
CHUNK = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class ChunkCodec:
    """Encoder and decoder that segment every distinct chunk once.

    ``encode`` gives the ids of a text as little-endian unsigned 32-bit
    integers, ``decode`` the text that the library's ``decode`` gives for them.
    """

    def __init__(self, model_path: str, entries: int = TABLE_ENTRIES, most_bytes: int = TABLE_BYTES):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.entries, self.most_bytes = entries, most_bytes
        self.table: dict[str, tuple[bytes, str]] = {}
        self.bytes = 0
        self._check()
        # a chunk is segmented behind this piece, which is then cut off again
        self.lead = self.model.encode("a")
        self.lead_text = self.model.decode(self.lead)
        # what an id decodes to behind other text; byte pieces have no text of their own
        m = self.model
        self.surface = {
            i: m.id_to_piece(i).replace(MARKER, " ")
            for i in range(m.get_piece_size())
            if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))
        }
        self.begin = self.model.bos_id().to_bytes(4, "little")
        self.end = self.model.eos_id().to_bytes(4, "little")

    def _check(self) -> None:
        m = self.model
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            if MARKER in piece.lstrip(MARKER) and not m.is_control(i):
                raise ValueError(f"piece {i} crosses a whitespace marker")
        probe = " Å x́  \tﬁ "
        if m.decode(m.encode(probe)) != probe or m.encode("a") != m.encode_as_ids("a"):
            raise ValueError("the model changes texts before it segments them")

    def _segment(self, chunks: list[str]) -> None:
        """Enter new chunks, each starting with a marker, into the table."""
        cut, surface = len(self.lead), self.surface
        behind = self.model.encode(["a" + c.replace(MARKER, " ") for c in chunks], num_threads=1)
        for chunk, ids in zip(chunks, behind, strict=True):
            del ids[:cut]
            try:
                text = "".join([surface[i] for i in ids])
            except KeyError:  # byte pieces: the library puts characters together
                text = self.model.decode(self.lead + ids)[len(self.lead_text) :]
            self.table[chunk] = (struct.pack(f"<{len(ids)}I", *ids), text)
            # ids at four bytes, chunk and text at up to four bytes a character
            self.bytes += 4 * (len(ids) + len(chunk) + len(text))

    def clear(self) -> None:
        self.table.clear()
        self.bytes = 0

    def _entries(self, text: str) -> list[tuple[bytes, str]]:
        if len(self.table) > self.entries or self.bytes > self.most_bytes:
            self.clear()
        chunks = CHUNK.findall(MARKER + text.replace(" ", MARKER))
        new = set(chunks).difference(self.table)
        if new:
            self._segment(list(new))
        table = self.table
        return [table[c] for c in chunks]

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """All ids (begin and end included) as bytes, and the decoded text."""
        if not text:
            return self.begin + self.end, ""
        found = self._entries(text)
        ids = b"".join([e[0] for e in found])
        # decode() drops the marker it put in front, once
        decoded = "".join([e[1] for e in found])[1:]
        return self.begin + ids + self.end, decoded


_CODECS: dict[str, ChunkCodec] = {}


def codec(model_path: str) -> ChunkCodec:
    """The codec of this Python process for a model file."""
    if model_path not in _CODECS:
        _CODECS[model_path] = ChunkCodec(model_path)
    return _CODECS[model_path]


def encode_documents(
    df: DataFrame,
    model_path: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    with_outputs: bool = True,
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded])`` per row."""
    prepare_python(df.sparkSession)
    path = model_path or default_model_path()
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_outputs:
        schema += ", ids binary, decoded string"

    @F.pandas_udf(schema)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = codec(path)
        for batch in texts:
            rows = []
            for t in batch:
                ids, decoded = pieces.encode_decode(t)
                row = (
                    len(ids) // 4,
                    hashlib.sha256(ids).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
                )
                rows.append((*row, ids, decoded) if with_outputs else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            yield pd.DataFrame(rows, columns=names[: 5 if with_outputs else 3])
        # the worker process may live on for other tasks
        pieces.clear()

    return df.select(F.col(key).alias("doc_id"), run(text_of(text)).alias("r")).select("doc_id", "r.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and the decoded text of every document."""
    return encode_documents(documents(spark, sf_dir), with_outputs=False)
