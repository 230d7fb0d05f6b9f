"""SentencePiece encoding with byte offsets, and decoding.

``Normalizer`` applies the model's compiled character map as longest-prefix
rewriting and notes, for every byte it writes, the source byte it came from.
Pieces tile the normalised text, so the alignment projects each piece onto a span
of the original UTF-8 bytes; spans of consecutive pieces meet, and a space that the
normaliser adds has an empty span.  Ids and decoded text come from the
``sentencepiece`` library itself, so they are its own results.

One Arrow pass per partition, no shuffle.  The model (about 0.5 MB) is read by
path once a task; a task holds one block of text and its pieces.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import read_table, text_blocks

#: What the normaliser writes for a space (U+2581), fixed by the format.
SPACE = "▁".encode()
REPLACEMENT = "�".encode()
#: Bytes of text encoded at a time.
CODEC_BYTES = 1 << 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class CharacterMap:
    """Compiled map: a double-array trie of UTF-8 prefixes over a pool of zero-ended replacements."""

    units: np.ndarray
    pool: bytes

    @classmethod
    def parse(cls, blob: bytes) -> CharacterMap | None:
        if not blob:
            return None
        (size,) = struct.unpack_from("<I", blob)
        return cls(np.frombuffer(blob, "<u4", size // 4, 4), blob[4 + size :])

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest mapped prefix of ``text[at:]``."""
        units, found = self.units, None

        def base(unit: int) -> int:
            return (unit >> 10) << ((unit & (1 << 9)) >> 6)

        node = base(int(units[0]))
        for n in range(at, len(text)):
            c = text[n]
            node ^= c
            if node >= len(units):
                break
            unit = int(units[node])
            if unit & 0x800000FF != c:
                break
            node ^= base(unit)
            if unit >> 8 & 1:
                value = int(units[node]) & 0x7FFFFFFF
                found = (n + 1 - at, self.pool[value : self.pool.index(b"\0", value)])
        return found


class Normalizer:
    """Normalisation of one model: ``(normalised bytes, source offset of each byte and of the end)``."""

    def __init__(self, spec) -> None:
        self.map = CharacterMap.parse(spec.precompiled_charsmap)
        self.dummy_prefix = spec.add_dummy_prefix
        self.trim = spec.remove_extra_whitespaces
        self.space = SPACE if spec.escape_whitespaces else b" "

    def prefix(self, text: bytes, at: int) -> tuple[int, bytes]:
        """The next source bytes to consume and what replaces them."""
        hit = self.map.longest(text, at) if self.map else None
        if hit:
            return hit
        lead = text[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            text[at : at + n].decode()
        except UnicodeDecodeError:
            return 1, REPLACEMENT
        return n, text[at : at + n]

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.map is None and not self.trim:
            return self.plain(data)
        text, out, source = data.tobytes(), bytearray(), []
        at, end = 0, len(text)
        if self.trim:
            while at < end:
                n, to = self.prefix(text, at)
                if to != b" ":
                    break
                at += n
        if at == end:
            return np.zeros(0, np.uint8), np.array([at], np.int64)
        if self.dummy_prefix:
            out += self.space
            source += [at] * len(self.space)
        after_space = self.trim
        while at < end:
            n, to = self.prefix(text, at)
            while after_space and to[:1] == b" ":
                to = to[1:]
            if to:
                for c in to:
                    if c == 0x20:
                        out += self.space
                        source += [at] * len(self.space)
                    else:
                        out.append(c)
                        source.append(at)
                after_space = self.trim and to[-1:] == b" "
            at += n
        if self.trim:
            while out.endswith(self.space):
                del out[-len(self.space) :]
                at = source[len(out)]
                del source[len(out) :]
        return np.frombuffer(bytes(out), np.uint8), np.array([*source, at], np.int64)

    def plain(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """No character map, nothing trimmed: only spaces are rewritten."""
        if not len(data):
            return data, np.zeros(1, np.int64)
        width = np.where(data == 0x20, len(self.space), 1)
        source = np.repeat(np.arange(len(data)), width)
        out = data[source]
        at = np.flatnonzero(data == 0x20)
        first = (np.cumsum(width) - width)[at]
        for i, c in enumerate(self.space):
            out[first + i] = c
        if self.dummy_prefix:
            out = np.concatenate([np.frombuffer(self.space, np.uint8), out])
            source = np.concatenate([np.zeros(len(self.space), np.int64), source])
        return out, np.append(source, len(data))


class Codec:
    """A model with its normaliser and the byte length of every piece."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            blob = f.read()
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=blob)
        model = sentencepiece_model_pb2.ModelProto.FromString(blob)
        self.normalizer = Normalizer(model.normalizer_spec)
        byte = sentencepiece_model_pb2.ModelProto.SentencePiece.BYTE
        self.length = np.array([1 if p.type == byte else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown = self.processor.unk_id()
        self.decimal = [str(i) for i in range(len(model.pieces))]

    def spans(self, data: np.ndarray, ids: list[int], pieces: list[str] | None = None) -> np.ndarray:
        """The end, in source bytes, of every piece; each starts where the one before ends."""
        _, source = self.normalizer(data)
        if pieces is not None:
            length = np.array([len(p.encode()) for p in pieces], np.int64)
        else:
            length = self.length[np.array(ids, dtype=np.int64)]
        return source[np.cumsum(length)]


def encode_decode(docs: DataFrame, model_path: str | None = None, with_spans: bool = True) -> DataFrame:
    """``doc_id, ids, piece_ends, decoded`` for every row of ``docs``.

    ``piece_ends[i]`` is the byte of the original text (UTF-8) where piece ``i`` ends; it
    starts where the one before ended.  Null and empty texts give empty lists and an
    empty text.  Rows with equal ids stay separate rows, and other columns
    are ignored."""
    schema = "doc_id long, ids array<int>, piece_ends array<long>, decoded string"
    return _map_blocks(docs, model_path, schema, lambda codec, data, ids, ends, decoded: [ids, ends.tolist(), decoded], with_spans)


def digest(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """The encoded form of every row in short: counts, digests, and whether its spans tile the text."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_tile boolean"

    def row(codec: Codec, data: np.ndarray, ids: list[int], ends: np.ndarray, decoded: str) -> list:
        name = codec.decimal
        joined = ",".join([name[i] for i in ids])
        tile = not len(ids) and not len(data) or len(ends) > 0 and ends[-1] == len(data) and bool((ends[1:] >= ends[:-1]).all())
        return [len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), bool(tile)]

    return _map_blocks(docs, model_path, schema, row, True)


def _map_blocks(docs: DataFrame, model_path: str | None, schema: str, row, with_spans: bool) -> DataFrame:
    path = model_path or default_model()
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(path)
            keys = batch.column(0)
            for first, last, data, bounds in text_blocks(batch.column(1), CODEC_BYTES):
                raw = data.tobytes()
                texts = [raw[a:b].decode() for a, b in itertools.pairwise(bounds.tolist())]
                encoded = codec.processor.encode(texts, num_threads=1)
                decoded = codec.processor.decode(encoded, num_threads=1) if encoded else []
                rows = []
                for i, ids in enumerate(encoded):
                    own = data[bounds[i] : bounds[i + 1]]
                    ends = np.zeros(0, np.int64)
                    if with_spans and ids:
                        pieces = codec.processor.id_to_piece(ids) if codec.unknown in ids else None
                        if pieces is not None:  # an unknown piece covers text the vocabulary doesn't hold
                            pieces = codec.processor.encode(texts[i], out_type=str)
                        ends = codec.spans(own, ids, pieces)
                    rows.append(row(codec, own, ids, ends, decoded[i]))
                columns = [keys.slice(first, last - first).cast(pa.int64())]
                columns += [pa.array([r[j] for r in rows], type=ARROW[t]) for j, t in enumerate(types[1:])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    types = [x.split()[1] for x in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


ARROW = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
    "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
}


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return digest(read_table(spark, sf_dir, "documents"))
