"""SentencePiece ids by a table of distinct marked words, and the text of ids."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from hitloom.llm.common import fresh, slices

MARK = "▁"
_CHUNK = re.compile(r" +[^ ]*")

# Entries of a task's table; a full table starts anew, which costs time and changes no id.
TABLE_ENTRIES = 150_000
# Characters of the texts turned into ids at once.
SLICE_CHARS = 500_000


def _load(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def check_model(model: str) -> None:
    """Raise unless words can be segmented one by one: no piece has a marker behind another character,
    the text is not normalised, every text gets one marker in front, and merges are by BPE."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(model, "rb") as f:
        proto.ParseFromString(f.read())
    spec = proto.normalizer_spec
    crossing = [p.piece for p in proto.pieces if MARK in p.piece.lstrip(MARK)]
    own = [p.piece for p in proto.pieces if p.type == pb.ModelProto.SentencePiece.USER_DEFINED]
    if (
        crossing or own or spec.precompiled_charsmap or spec.remove_extra_whitespaces
        or not spec.add_dummy_prefix or not spec.escape_whitespaces
        or proto.trainer_spec.treat_whitespace_as_suffix
        or proto.trainer_spec.model_type != pb.TrainerSpec.BPE
    ):
        raise ValueError("the pieces of this model can cross words, or it changes the text")


def chunks_of(text: str) -> list[str]:
    """Marked words of a text, each without its first marker: runs of spaces and what follows them.

    ``"a  b"`` gives ``["a", " b"]``; the empty text gives none.
    """
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [c[1:] for c in _CHUNK.findall(" " + text)]
    return text.split(" ")


class ChunkTable:
    """Ids of each distinct marked word, segmented once by the library."""

    def __init__(self, model: str):
        self.sp = _load(model)
        self.mark = self.sp.piece_to_id(MARK)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.start = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)

    def encode(self, texts: list[str | None], eos: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if len(self.place) > TABLE_ENTRIES:
            self.clear()
        words = [chunks_of(t or "") for t in texts]
        # dict.fromkeys keeps the order of first use, so the table does not depend on string hashing
        new = [c for c in dict.fromkeys(c for w in words for c in w) if c not in self.place]
        if new:
            ids = self.sp.encode(new, num_threads=1)
            ids = [i if c else [self.mark] for c, i in zip(new, ids, strict=True)]
            size = np.array([len(i) for i in ids], dtype=np.int64)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.array([x for i in ids for x in i], dtype=np.int32)])
        at = np.fromiter(map(self.place.__getitem__, (c for w in words for c in w)), dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        size = self.size[at]
        n = np.bincount(owner, size, len(words)).astype(np.int64)
        end = np.cumsum(size)
        out = self.flat[np.arange(size.sum()) + np.repeat(self.start[at] - (end - size), size)]
        if eos:
            out = np.insert(out, np.cumsum(n), self.sp.eos_id())
            n = n + 1
        return out, n


def encode(
    df: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids", eos: bool = True
) -> DataFrame:
    """Add the ids of each whole text, equal to those of the library without sampling.

    Null and empty texts have no ids but the end id. All columns stay; `ids_col` gets underscores
    where the name is taken. Rows are independent: repeated rows get equal ids, an empty table stays
    empty. `model` is a path that every executor can read.
    """
    check_model(model)
    (name,) = fresh(df, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            for a, b in slices(np.array([len(t or "") for t in texts]), SLICE_CHARS):
                ids, n = table.encode(texts[a:b], eos)
                part = batch.slice(a, b - a)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(ids))],
                    names=[*batch.schema.names, name],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, `{name}` array<int>")


class PieceTable:
    """Bytes of each id as the decoder writes them."""

    def __init__(self, model: str):
        self.sp = _load(model)
        pieces = []
        self.byte = np.zeros(self.sp.vocab_size(), dtype=bool)
        self.odd = np.zeros(self.sp.vocab_size(), dtype=bool)
        for i in range(self.sp.vocab_size()):
            piece = self.sp.id_to_piece(i)
            self.byte[i] = self.sp.is_byte(i)
            self.odd[i] = self.sp.is_unknown(i)
            if self.byte[i]:
                pieces.append(bytes([int(piece[3:5], 16)]))
            else:
                pieces.append(b"" if self.sp.is_control(i) else piece.replace(MARK, " ").encode())
        self.size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        size = self.size[ids]
        end = np.cumsum(size)
        data = self.flat[np.arange(size.sum()) + np.repeat(self.start[ids] - (end - size), size)].tobytes()
        cut = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(n)])]
        row = np.repeat(np.arange(len(n)), n)
        byte = np.bincount(row, self.byte[ids], len(n)) > 0
        odd = np.bincount(row, self.odd[ids], len(n)) > 0
        at = np.concatenate([[0], np.cumsum(n)])
        out = []
        for i in range(len(n)):
            text = data[cut[i] : cut[i + 1]]
            text = text.removeprefix(b" ")
            if odd[i] or byte[i] and not _valid(text):
                # unknown ids and broken bytes are rare; the library has rules for them
                text = self.sp.decode(ids[at[i] : at[i + 1]].tolist()).encode()
            out.append(text)
        return out


def _valid(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


def decode(df: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of each row's ids as the library's ``decode`` gives it; null ids give an empty text."""
    (name,) = fresh(df, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(model)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            n = np.asarray(ids.value_lengths().fill_null(0)).astype(np.int64)
            flat = np.asarray(ids.flatten())
            at = np.concatenate([[0], np.cumsum(n)])
            for a, b in slices(n, SLICE_CHARS // 2):
                texts = table.decode(flat[at[a] : at[b]], n[a:b])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                    names=[*batch.schema.names, name],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, `{name}` string")


def encode_and_decode(
    df: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded", eos: bool = True
) -> DataFrame:
    """:func:`encode` and then :func:`decode` of its ids in one pass, by one Python worker for each task."""
    check_model(model)
    names = fresh(df, ids_col, decoded_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pieces = ChunkTable(model), PieceTable(model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            for a, b in slices(np.asarray(pc.fill_null(pc.utf8_length(column), 0)), SLICE_CHARS):
                part = batch.slice(a, b - a)
                ids, n = words.encode(column.slice(a, b - a).to_pylist(), eos)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                text = pa.array(pieces.decode(ids, n), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(ids)), text],
                    names=[*batch.schema.names, *names],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, `{names[0]}` array<int>, `{names[1]}` string")
