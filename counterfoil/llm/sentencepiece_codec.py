"""Encoding and decoding with a sentence-piece model, rebuilt in the tokenizers library.

The model file is parsed; its normaliser, the mark for spaces, the scored pieces and the
byte fallback are rebuilt. A unigram model keeps its scores; a byte-pair model's scores
become merges, best first. Batches are encoded by the library's threads.

A text is cut where no piece of the vocabulary reaches over the cut. Each distinct chunk
of a batch is encoded once, its identifiers are compared with those of the sentencepiece
library, and texts are put together from chunks. Identifiers are those of the rebuilt
tokenizer; where the two libraries differ ``parity`` is false. The identifiers of each
text are decoded whole; ``round_trip`` says whether that gives the text back.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from counterfoil.llm.common import MARK, cutter, marked

# Fixed value: how a byte piece is written.
BYTE = re.compile("<0x[0-9A-Fa-f]{2}>")
UNIGRAM, BPE = 1, 2
NORMAL, CONTROL, USER_DEFINED = 1, 3, 4
#: Chunks that a Python worker remembers, twice this many at most, and the longest of them.
REMEMBERED = 250_000
LONGEST = 64
#: Identifiers that are decoded at a time, but one text at least.
DECODED = 250_000


def parse(model: bytes) -> sentencepiece_model_pb2.ModelProto:
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return proto


def _merges(proto) -> list[tuple[str, str]]:
    """Each way to put a piece together from two others, by the piece's score, then by the parts."""
    place = {p.piece: i for i, p in enumerate(proto.pieces)}
    score = {p.piece: p.score for p in proto.pieces if p.type in (NORMAL, USER_DEFINED)}
    ways = [
        (-value, place[piece[:cut]], place[piece[cut:]], piece[:cut], piece[cut:])
        for piece, value in score.items()
        for cut in range(1, len(piece))
        if piece[:cut] in score and piece[cut:] in score
    ]
    return [(a, b) for *_, a, b in sorted(ways)]


def build(model: bytes) -> Tokenizer:
    """The tokenizer without special tokens around a text, truncation or padding."""
    proto = parse(model)
    trainer, norm = proto.trainer_spec, proto.normalizer_spec
    pieces = [(p.piece, p.score) for p in proto.pieces]
    if trainer.model_type == UNIGRAM:
        built = Tokenizer(models.Unigram(pieces, unk_id=trainer.unk_id, byte_fallback=trainer.byte_fallback))
    elif trainer.model_type == BPE:
        built = Tokenizer(
            models.BPE(
                {piece: i for i, (piece, _) in enumerate(pieces)},
                _merges(proto),
                unk_token=proto.pieces[trainer.unk_id].piece,
                fuse_unk=True,
                byte_fallback=trainer.byte_fallback,
            )
        )
    else:
        raise ValueError("unigram and byte-pair models are supported")
    steps = []
    if norm.precompiled_charsmap:
        steps.append(normalizers.Precompiled(norm.precompiled_charsmap))
    if norm.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if norm.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if norm.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    built.normalizer = normalizers.Sequence(steps)
    if crosses_no_mark(proto):
        built.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    built.decoder = decoders.Sequence(undo + [decoders.Strip(" ", 1, 0)] * norm.add_dummy_prefix)
    return built


def piece_bytes(built: Tokenizer) -> dict[int, bytes]:
    """What each identifier of the tokenizer decodes to: a byte for byte pieces, else the piece with blanks for marks."""
    vocabulary = {i: piece for piece, i in built.get_vocab(with_added_tokens=False).items()}
    return {
        i: bytes([int(piece[3:5], 16)]) if BYTE.fullmatch(piece) else piece.replace(MARK, " ").encode()
        for i, piece in vocabulary.items()
    }


def crosses_no_mark(proto) -> bool:
    return all(MARK not in p.piece.lstrip(MARK) for p in proto.pieces)


class Codec:
    """Encodes and decodes whole texts; remembers the identifiers, as bytes, of recent short chunks.

    ``odd`` holds the chunks, of those remembered, on which the libraries differ.
    """

    def __init__(self, model: bytes):
        proto = parse(model)
        norm = proto.normalizer_spec
        norm_prefix = norm.add_dummy_prefix
        self.built = build(model)
        plain = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
        self.marks = plain and norm.add_dummy_prefix and norm.escape_whitespaces
        # With marks the text is prepared here; both libraries then get chunks as they are, spaces for marks.
        self.cut = cutter(p.piece for p in proto.pieces if p.type != CONTROL).findall if self.marks else None
        norm.add_dummy_prefix = norm.add_dummy_prefix and not self.marks
        inner = proto.SerializeToString()
        self.ours, self.theirs = build(inner), sentencepiece.SentencePieceProcessor(model_proto=inner)
        self.pieces = piece_bytes(self.built)
        self.decoder = self.built.decoder.__getstate__()
        self.blank = norm_prefix
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd: set[str] = set()

    def _encoded(self, parts: list[str]) -> dict[str, bytes]:
        found = {}
        encoded = [e.ids for e in self.ours.encode_batch_fast(parts, add_special_tokens=False)]
        theirs = self.theirs.encode(parts, num_threads=1)
        for part, ids, other in zip(parts, encoded, theirs):
            if ids != other:
                self.odd.add(part)
            found[part] = array("i", ids).tobytes()
        return found

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bool], list[bool]]:
        """Of each text the identifiers, whether both libraries agree, whether decoding gives the text back.

        A mark that stands in the text itself decodes to a space; such a text is not given back.
        """
        cut = [(self.cut(marked(t)) if self.marks else [t]) if t else [] for t in texts]
        if len(self.parts) > REMEMBERED:
            self.older, self.parts = self.parts, {}
            self.odd.intersection_update(self.older)
        missing = set().union(*cut).difference(self.parts)
        self.parts.update((p, self.older[p]) for p in missing.intersection(self.older))
        self.parts.update(self._encoded(list(missing.difference(self.older))))
        ids = [b"".join(map(self.parts.__getitem__, parts)) for parts in cut]
        odd = self.odd
        parity = [odd.isdisjoint(parts) if odd else True for parts in cut]
        del cut
        for part in [p for p in missing if len(p) > LONGEST]:
            del self.parts[part]
        return ids, parity, self._given_back(texts, ids)

    def _given_back(self, texts: list[str | None], ids: list[bytes]) -> list[bool]:
        """Whether the identifiers of a text, decoded whole, are the text."""
        same, some, size = [], [], 0
        for at, coded in enumerate(ids):
            some.append(memoryview(coded).cast("i").tolist())
            size += len(some[-1])
            if size >= DECODED or at + 1 == len(ids):
                same += [back == (t or "") for back, t in zip(self.decode(some), texts[len(same) :])]
                some, size = [], 0
        return same

    def decode(self, ids: list[list[int] | None]) -> list[str | None]:
        """The bytes of the pieces one after the other, without the blank in front.

        Where they are no UTF-8, or an identifier stands for no piece, the library's decoder says what the text is; so it
        does for all if it is not the one that the bytes were worked out for.
        """
        texts, odd = [], []
        pieces = self.pieces if self.built.decoder.__getstate__() == self.decoder else {}
        for at, some in enumerate(ids):
            try:
                read = None if some is None else b"".join(map(pieces.__getitem__, some)).decode()
            except (UnicodeDecodeError, KeyError):
                read = None
                odd.append(at)
            texts.append(read[1:] if read and self.blank and read[0] == " " else read)
        for at, read in zip(odd, self.built.decode_batch([ids[at] for at in odd], skip_special_tokens=False)):
            texts[at] = read
        return texts


@lru_cache(maxsize=2)
def _codec(model: bytes) -> Codec:
    return Codec(model)


def encode(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with ids (array<int>), n_tokens, parity and round_trip.

    One pass without a shuffle, rows one to one. NULL texts are empty texts: no ids,
    parity and round trip hold. Columns of ``docs`` with the names of results, in any case, are replaced.
    """
    made = T.StructType.fromDDL("ids array<int>, n_tokens long, parity boolean, round_trip boolean")
    taken = {name.lower() for name in (text, *made.names)}
    kept = [c for c in docs.columns if c.lower() not in taken]
    rows = docs.select(*[f"`{c}`" for c in kept], F.coalesce(F.col(text), F.lit("")).alias(text))
    schema = T.StructType(rows.schema.fields[:-1] + made.fields)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids, parity, same = codec.encode(batch.column(len(kept)).to_pylist())
                sizes = np.array([len(i) // 4 for i in ids], dtype=np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
                columns = [batch.column(k) for k in range(len(kept))]
                columns += [pa.ListArray.from_arrays(pa.array(ends), values), pa.array(sizes)]
                columns += [pa.array(parity, pa.bool_()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(encoded, schema)


def decode(docs: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the text that its ids stand for; NULL ids give NULL, no ids the empty text."""
    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(model)
        for batch in batches:
            yield pd.Series(codec.decode([None if i is None else list(map(int, i)) for i in batch]), dtype=object)

    return docs.withColumn(text, decoded(ids))
