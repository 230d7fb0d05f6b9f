"""Byte-level BPE encoding and decoding with a sentencepiece model made from the rank file.

The rank file (token bytes and their rank) is serialised directly as a
sentencepiece BPE model: byte ``b`` is the character U+0100 + ``b``, a token is the
string of its bytes' characters, its score the negative rank, its id its place by rank;
the normalisation is the identity (nothing trimmed, escaped or prefixed).  The library
then merges the pair of the least rank first, the leftmost of equal ones, which is
byte-level BPE.

Texts are split into pre-tokens by the tokenizer's pattern and every pre-token is
encoded by itself; one that is a token as a whole is that token.  Decoding maps
ids back to token bytes.  One Arrow pass without shuffle; a task holds a block of texts, a
bounded cache of pre-tokens and the model.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import read_table, text_blocks

#: Bytes of text in one block, pre-tokens handled at a time, characters of pre-tokens kept with their ids.
CODEC_BYTES, CHUNK, CACHE_CHARS = 1 << 20, 1 << 16, 1 << 22
#: The character of byte 0.
FIRST_SYMBOL = 0x100
#: Stand-ins for a letter, a number and anything else.
STAND_INS = {"L": "я", "N": "٣", "": "€"}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


_SYMBOLS = {b: chr(FIRST_SYMBOL + b) for b in range(256)}


def symbols(data: bytes) -> str:
    """One character a byte."""
    return data.decode("latin-1").translate(_SYMBOLS)


def serialize(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a rank file; piece ``i`` is the token of the ``i``-th least rank."""
    from sentencepiece import sentencepiece_model_pb2

    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes, such as {missing[0]}")
    model = sentencepiece_model_pb2.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece=symbols(token), score=-rank, type=model.SentencePiece.NORMAL)
    # The library wants an unknown piece; no text needs it.
    model.pieces.add(piece="<unk>", score=0, type=model.SentencePiece.UNKNOWN)
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    trainer.model_type = trainer.BPE
    trainer.vocab_size = len(model.pieces)
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(ranks), -1, -1, -1
    normalizer.name = "identity"
    normalizer.add_dummy_prefix = normalizer.remove_extra_whitespaces = normalizer.escape_whitespaces = False
    return model.SerializeToString()


@functools.lru_cache(maxsize=1)
def odd_characters() -> dict[int, str]:
    """Code points that the pattern engine here and tiktoken's put into different classes (they follow
    different versions of Unicode), each with a stand-in of the class that tiktoken sees."""
    import regex
    import tiktoken

    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, sys.maxunicode + 1))))
    single = {bytes([b]): b for b in range(256)}

    def members(name: str) -> tuple[set[str], set[str]]:
        pattern = rf"\p{{{name}}}"
        # Text outside all matches gives no tokens.
        theirs = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        return set(bytes(theirs).decode()), set(regex.findall(pattern, every))

    (letters, own_letters), (numbers, own_numbers) = members("L"), members("N")
    odd = (letters ^ own_letters) | (numbers ^ own_numbers)
    return {ord(c): STAND_INS["L" if c in letters else "N" if c in numbers else ""] for c in odd}


class ByteCodec:
    """Encoder and decoder of one rank file and pattern.

    ``pattern`` may tell characters apart by ``\\p{L}``, ``\\p{N}``, ``\\s`` and by ASCII characters."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.by_piece = sorted(self.ranks.values())
        self.names = {rank: str(rank) for rank in self.by_piece}
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialize(self.ranks))
        self.pattern = regex.compile(pattern)
        self.odd = odd_characters()
        self.cache: dict[str, list[int]] = {}
        self.held = 0

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern, a bounded number at a time."""
        if not text.isascii() and not self.odd.keys().isdisjoint(map(ord, text)):
            # Same length and same classes as tiktoken sees; the cuts are carried over.
            spans = (m.span() for m in self.pattern.finditer(text.translate(self.odd)))
            found = (text[a:b] for a, b in spans)
        elif len(text) <= CHUNK:
            yield self.pattern.findall(text)
            return
        else:
            found = (m.group() for m in self.pattern.finditer(text))
        for chunk in itertools.batched(found, CHUNK):
            yield list(chunk)

    def _learn(self, tokens: list[str]) -> None:
        if self.held > CACHE_CHARS:
            self.cache, self.held = {}, 0
        new = list(set(tokens).difference(self.cache))
        self.held += sum(map(len, new))
        data = [t.encode() for t in new]
        merged = []
        for t, d in zip(new, data, strict=True):
            whole = self.ranks.get(d)
            if whole is not None:
                self.cache[t] = [whole]
            else:
                merged.append((t, symbols(d)))
        if merged:
            place = self.by_piece
            for (t, _), pieces in zip(merged, self.processor.encode([s for _, s in merged], num_threads=1), strict=True):
                self.cache[t] = [place[i] for i in pieces]

    def encode(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, in consecutive lists."""
        for tokens in self.pre_tokens(text):
            self._learn(tokens)
            yield list(itertools.chain.from_iterable(map(self.cache.__getitem__, tokens)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _map_texts(docs: DataFrame, ranks_path: str | None, pattern: str | None, schema: str, types: list[pa.DataType], row) -> DataFrame:
    path, split = ranks_path or default_ranks(), pattern or default_pattern()
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or ByteCodec(path, split)
            for first, last, data, bounds in text_blocks(batch.column(1), CODEC_BYTES):
                raw = data.tobytes()
                # Bytes that are no UTF-8 count as U+FFFD.
                rows = [row(codec, raw[a:b].decode(errors="replace")) for a, b in itertools.pairwise(bounds.tolist())]
                columns = [batch.column(0).slice(first, last - first).cast(pa.int64())]
                columns += [pa.array([r[j] for r in rows], type=t) for j, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def encode_decode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` (bytes) for every row of ``docs``.

    Null and empty texts give no ids and no bytes.  Repeated rows stay separate rows, a null ``doc_id`` stays null,
    other columns are ignored, an empty table gives an empty result.  A pattern that leaves out parts of a text
    loses them, as the tokenizer would."""

    def row(codec: ByteCodec, text: str) -> list:
        ids = list(itertools.chain.from_iterable(codec.encode(text)))
        return [ids, codec.decode(ids)]

    return _map_texts(docs, ranks_path, pattern, "doc_id long, ids array<int>, decoded binary", [pa.list_(pa.int32()), pa.binary()], row)


def digest(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``; edge cases as in :func:`encode_decode`.

    The digests are fed piece by piece, so a very long text costs no more than its characters."""

    def row(codec: ByteCodec, text: str) -> list:
        n, ids_sha, decoded_sha = 0, hashlib.sha256(), hashlib.sha256()
        for ids in codec.encode(text):
            if n and ids:
                ids_sha.update(b" ")
            ids_sha.update(" ".join(map(codec.names.__getitem__, ids)).encode())
            decoded_sha.update(codec.decode(ids))
            n += len(ids)
        return [n, ids_sha.hexdigest(), decoded_sha.hexdigest()]

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _map_texts(docs, ranks_path, pattern, schema, [pa.int64(), pa.string(), pa.string()], row)


def op12_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return digest(read_table(spark, sf_dir, "documents"))
