"""Token ids in bit-plane segments: a compact binary format and the jobs that write and read it.

A segment holds the ids of consecutive documents. Its ids are cut into blocks
of fixed size; each block is transposed into bit planes (all lowest bits, then
all second bits, ...), and every plane is compressed by itself with zstandard,
or kept raw where that is not longer. Byte layout, little-endian::

    "BPL1" | block size u32 | ids u64 | blocks u32
    chunk index: for each block its offset u64 (from the payload's start), ids u32, planes u32
    blocks: plane lengths u32 * planes, then the planes

Segments are rows of a Parquet table in the shared folder (Spark's writer
commits whole tasks, so a lost executor leaves no partial segment), beside the
document table of each segment. The chunk index lets a reader take one block.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.session import materialise, ship, tidy

HEAD, ENTRY = struct.Struct("<4sIQI"), struct.Struct("<QII")
#: Ids of a block, and ids after which a segment is closed (at a document's end).
BLOCK, SEGMENT = 1 << 16, 1 << 20
#: Words, and parts of words, whose ids each Python worker keeps, about; a cache is emptied beyond that.
CACHE_WORDS, CACHE_PARTS = 500_000, 1_500_000
#: The tokenizer's own cut of ASCII text into parts.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
#: ASCII without control characters; non-ASCII letters whose lower case depends on place or takes two characters, or that normalisation changes.
PLAIN, UNUSUAL = re.compile(r"[!-~]+"), re.compile(r"[^A-Za-z\u00c0-\u012f\u0131-\u0148\u014a-\u017e]")
#: The byte-level alphabet: bytes that are no printable Latin-1 character are spelt from U+0100 on, in order.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTED)}


def pack(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Unsigned 32-bit ids as one segment payload."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    squeeze = zstandard.ZstdCompressor(level=1)
    starts = range(0, len(ids), block)
    at, index, body = HEAD.size + ENTRY.size * len(starts), [], []
    for s in starts:
        part = ids[s : s + block]
        planes = int(part.max()).bit_length()
        narrow = part.astype("<u2") if planes <= 16 else part
        bits = np.unpackbits(narrow.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")[:, :planes]
        rows = np.packbits(bits.T, axis=1, bitorder="little")
        stored = []
        for row in rows:
            raw = row.tobytes()
            small = squeeze.compress(raw)
            stored.append(small if len(small) < len(raw) else raw)
        data = b"".join([struct.pack(f"<{planes}I", *map(len, stored)), *stored])
        index.append(ENTRY.pack(at, len(part), planes))
        body.append(data)
        at += len(data)
    return b"".join([HEAD.pack(b"BPL1", block, len(ids), len(starts)), *index, *body])


def unpack_block(payload: bytes, k: int) -> np.ndarray:
    """Ids of block ``k``, found through the chunk index."""
    at, n, planes = ENTRY.unpack_from(payload, HEAD.size + ENTRY.size * k)
    lengths = struct.unpack_from(f"<{planes}I", payload, at)
    at += 4 * planes
    raw = (n + 7) // 8
    ids = np.zeros(n, dtype="<u4")
    for i, length in enumerate(lengths):
        plane = payload[at : at + length]
        if length < raw:
            plane = zstandard.ZstdDecompressor().decompress(plane, max_output_size=raw)
        bits = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little", count=n).astype("<u4")
        bits <<= i
        ids |= bits
        at += length
    return ids


def unpack(payload: bytes) -> np.ndarray:
    """All ids of a segment payload."""
    magic, _, n, blocks = HEAD.unpack_from(payload, 0)
    if magic != b"BPL1":
        raise ValueError("not a bit-plane segment")
    ids = np.concatenate([unpack_block(payload, k) for k in range(blocks)]) if blocks else np.zeros(0, "<u4")
    if len(ids) != n:
        raise ValueError(f"{len(ids)} ids where the header has {n}")
    return ids


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


#: What a tokenizer file has to say for words to be cut here: its normaliser, its pre-tokenizer and its merge model. Fixed values.
NORMALISER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
CUTTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


def cut_as_assumed(path: str) -> bool:
    """Whether a tokenizer file normalises, cuts and merges as WordEncoder does."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec.get("model", {})
    same = spec.get("normalizer") == NORMALISER and spec.get("pre_tokenizer") == CUTTER and all(model.get(k, v) == v for k, v in MODEL.items())
    return same and not spec.get("truncation") and not spec.get("padding") and all("<|" in t["content"] and not t["normalized"] for t in spec.get("added_tokens") or [])


class WordEncoder:
    """Encodes texts with a lower-casing word tokenizer, part by part, with bounded caches.

    Any other tokenizer file is recognised by what it says of itself, and
    encodes every text whole.

    Its pre-tokenizer never joins across spaces and cuts letters, single digits
    and other runs apart, each encoded by itself. So a text's ids are those of
    its words, and a word's those of its parts; parts are few, as case and
    punctuation are gone. Words for which this cutting is not certain (special
    tokens, marks that combine, letters with unusual lower case) go to the
    tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.certain = cut_as_assumed(path)
        self.merge = self.tokenizer.model.tokenize
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    @staticmethod
    def cut(word: str) -> list[str] | None:
        """Lower-cased parts of a word without spaces, or None if it has to stay whole."""
        core = word.rstrip(".,;:!?")
        if core.isalpha():
            if not core.isascii() and UNUSUAL.search(core):
                return None
            return [core.lower(), word[len(core) :]] if len(core) < len(word) else [core.lower()]
        return PARTS.findall(word.lower()) if word.isascii() and "<|" not in word and PLAIN.fullmatch(word) else None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.certain:
            return [pack_ids(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self.words) > CACHE_WORDS:
            self.words = {"": b""}
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
        words, parts = self.words, self.parts
        split = [t.replace("\n", " ").split(" ") for t in texts]
        whole = []
        for w in set().union(*split).difference(words):
            cut = self.cut(w)
            if cut is None:
                whole.append(w)
                continue
            for p in cut:
                if p not in parts:
                    # A certain part is one pre-token in normal form: the byte alphabet and the merges are all that is left to do.
                    spelt = p if p.isascii() else p.encode().decode("latin-1").translate(BYTE_ALPHABET)
                    parts[p] = pack_ids([t.id for t in self.merge(spelt)])
            words[w] = parts[cut[0]] if len(cut) == 1 else b"".join([parts[p] for p in cut])
        for w, e in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False), strict=True):
            words[w] = pack_ids(e.ids)
        return [b"".join(map(words.__getitem__, ws)) for ws in split]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


SEGMENTS = "part int, segment long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, payload binary"
ARROW_SEGMENTS = pa.schema([("part", pa.int32()), ("segment", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("payload", pa.binary())])
#: Rows given to the encoder at once.
ENCODE_ROWS = 500


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append ``end_id`` and write segments in ascending ``doc_id`` order; returns the written table.

    Texts are dealt into id ranges and sorted before they are encoded, so the
    words are encoded once and only the texts are shuffled. A counter joins the
    key: equal ids keep their order of input and may span ranges.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_salt"))
    ranged = rows.repartitionByRange("doc_id", "_salt").sortWithinPartitions("doc_id", "_salt").select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path).encode, np.array([end_id], dtype="<u4").tobytes()
        ids, sizes, parts, held, part, segment = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "segment": segment, "n_tokens": held, "doc_ids": ids, "doc_tokens": sizes, "payload": pack(np.frombuffer(b"".join(parts), "<u4"))}
            return pa.RecordBatch.from_pylist([row], schema=ARROW_SEGMENTS)

        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_ROWS):
                some = batch.slice(at, ENCODE_ROWS)
                part = some.column(0)[0].as_py()
                for i, data in zip(some.column(1).to_pylist(), encode(some.column(2).to_pylist()), strict=True):
                    ids.append(i)
                    sizes.append(len(data) // 4 + 1)
                    parts += [data, end]
                    held += sizes[-1]
                    if held >= SEGMENT:
                        yield close()
                        ids, sizes, parts, held, segment = [], [], [], 0, segment + 1
        if ids:
            yield close()

    return materialise(ranged.mapInArrow(tidy(segments), SEGMENTS), "tokens")


def read_tokens(segments: DataFrame) -> DataFrame:
    """Per document of a written table: doc_id, start, n_tokens and the CRC-32 of its ids, all from the stored bytes.

    Segment totals give each document's global start: summed inside each
    written range, then over ranges (one row per range, at most as many as
    shuffle partitions).
    """
    ship(segments.sparkSession)
    index = segments.select("part", "segment", "n_tokens")
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    starts = index.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(F.broadcast(parts), "part").select("part", "segment", (F.col("_base") + F.col("_inside")).alias("_start"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, segment, docs, sizes, payload = (c[row] for c in batch.columns)
                data = memoryview(unpack(payload.as_py()).tobytes())
                sizes = np.array(sizes.as_py(), dtype=np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([segment.as_py()] * n, pa.int64()), pa.array(docs.as_py(), pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())],
                    names=["part", "segment", "doc_id", "_local", "n_tokens", "ids_crc32"],
                )

    found = segments.select("part", "segment", "doc_ids", "doc_tokens", "payload").mapInArrow(tidy(documents), "part int, segment long, doc_id long, _local long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["part", "segment"]).select("doc_id", (F.col("_start") + F.col("_local")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write and read back: one row per document with doc_id, start, n_tokens (with the end id) and ids_crc32.

    Null texts count as empty and hold the end id alone. Null ids come first;
    repeated rows follow each other, each with ids of its own. A text longer
    than a segment makes one long segment. An empty table gives no rows. Other
    columns are ignored.
    """
    return read_tokens(write_tokens(docs, tokenizer_path, end_id, id_col, text_col))
