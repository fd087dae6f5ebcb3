"""Token ids of documents as wavelet matrices, one per shard of consecutive documents.

A matrix keeps one bit plane per bit of an id, the highest first; each plane is followed by the stable
partition of the sequence by that bit.  With counts of set bits every 512 positions it gives the token at a position,
how often a token occurs before one, and where it occurs, without unpacking the sequence.

Documents are dealt to tasks by ranges of doc_id, each task encodes its range and writes its shards.  A shard is a
Parquet file of one row: ids and lengths of its documents, and the matrix; the format is given at ``Matrix.to_bytes``.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mattone.llm.arrays import flat, slices

# A shard is closed once it holds this many tokens; a document is never cut.
SHARD_TOKENS = 1 << 21
END = 0
BLOCK = 512
# Positions that are partitioned at once, so that their places stay in a core's cache.
STRETCH = 1 << 15
MAGIC = b"WVM1"
# Bytes of a worker's store of encoded units, each entry counted with ENTRY more.  Once half of them are filled, that half becomes the older one, of which
# only units met again are kept; this changes no result.
KEPT_BYTES, ENTRY = 300 << 20, 200
# New units are handed to the tokenizer in texts of so many, and its ids cut where a unit begins.
JOINED = 1024
# Bytes of the texts that are cut and looked up together: the more, the fewer lookups of one unit.
TOGETHER = 8 << 20


@dataclass
class Matrix:
    """A wavelet matrix: for each bit, the highest first, its packed plane, its zeros, and set bits before each block."""

    n: int
    bits: int
    zeros: list[int]
    planes: list[np.ndarray]
    ranks: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> Matrix:
        n, zeros, planes, ranks = len(ids), [], [], []
        now, after, spare = ids, np.empty_like(ids), np.empty_like(ids)
        for b in range(bits - 1, -1, -1):
            bit = (now >> b & 1).astype(bool)
            plane = np.packbits(bit, bitorder="little")
            planes.append(plane)
            ranks.append(cls._ranks(plane, n))
            zeros.append(n - int(np.count_nonzero(bit)))
            low, top = 0, zeros[-1]
            for i in range(0, n, STRETCH):
                own, part = bit[i : i + STRETCH], now[i : i + STRETCH]
                unset, set_ = np.flatnonzero(~own), np.flatnonzero(own)
                after[low : low + len(unset)] = part.take(unset)
                after[top : top + len(set_)] = part.take(set_)
                low, top = low + len(unset), top + len(set_)
            now, after = after, spare if now is ids else now
        return cls(n, bits, zeros, planes, ranks)

    @staticmethod
    def _ranks(plane: np.ndarray, n: int) -> np.ndarray:
        step = BLOCK // 8
        padded = np.zeros((n // BLOCK + 1) * step, np.uint8)
        padded[: len(plane)] = plane[: len(padded)]
        per_block = np.bitwise_count(padded.view(np.uint64)).reshape(-1, step // 8).sum(axis=1)
        return np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype(np.uint32)

    def to_bytes(self) -> bytes:
        """WVM1, bits (uint32), n (uint64), a uint64 of zeros per plane, the planes of (n + 7) // 8 bytes, low bits
        first, and their ranks, n // 512 + 1 uint32 each; all little-endian."""
        head = MAGIC + struct.pack("<IQ", self.bits, self.n) + struct.pack(f"<{self.bits}Q", *self.zeros)
        return b"".join([head, *[p.tobytes() for p in self.planes], *[r.astype("<u4").tobytes() for r in self.ranks]])

    @classmethod
    def from_bytes(cls, blob: bytes) -> Matrix:
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        bits, n = struct.unpack_from("<IQ", blob, 4)
        zeros = list(struct.unpack_from(f"<{bits}Q", blob, 16))
        at, size, blocks = 16 + 8 * bits, (n + 7) // 8, n // BLOCK + 1
        planes = [np.frombuffer(blob, np.uint8, size, at + i * size) for i in range(bits)]
        at += bits * size
        return cls(n, bits, zeros, planes, [np.frombuffer(blob, "<u4", blocks, at + 4 * i * blocks) for i in range(bits)])

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][i >> 3]) >> (i & 7) & 1

    def _ones(self, plane: int, i: int) -> int:
        """Set bits before position i."""
        block = min(i // BLOCK, len(self.ranks[plane]) - 1)
        part = int.from_bytes(self.planes[plane][block * BLOCK // 8 : (i + 7) // 8].tobytes(), "little")
        return int(self.ranks[plane][block]) + (part & (1 << (i - block * BLOCK)) - 1).bit_count()

    def _place(self, plane: int, wanted: int, count: int) -> int:
        """The position of the ``count``-th (from 0) bit that equals ``wanted``."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._ones(plane, mid + 1)
            if (ones if wanted else mid + 1 - ones) > count:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        """The token at position i."""
        out = 0
        for plane in range(self.bits):
            bit, ones = self._bit(plane, i), self._ones(plane, i)
            i = self.zeros[plane] + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def _span(self, token: int, stop: int) -> tuple[int, int]:
        """Where the token's occurrences among the first ``stop`` tokens lie in the sequence behind the last plane."""
        begin, end = 0, stop
        for plane in range(self.bits):
            a, b = self._ones(plane, begin), self._ones(plane, end)
            bit = token >> (self.bits - 1 - plane) & 1
            begin, end = (self.zeros[plane] + a, self.zeros[plane] + b) if bit else (begin - a, end - b)
        return begin, end

    def rank(self, token: int, stop: int) -> int:
        """How often the token occurs before position ``stop``."""
        begin, end = self._span(token, stop)
        return end - begin

    def select(self, token: int, count: int) -> int:
        """The position of the ``count``-th (from 0) occurrence of the token."""
        begin, end = self._span(token, self.n)
        if not 0 <= count < end - begin:
            raise IndexError(count)
        i = begin + count
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            i = self._place(plane, bit, i - self.zeros[plane] if bit else i)
        return i

    def sequence(self) -> np.ndarray:
        """All tokens, by undoing the partitions from the last plane to the first."""
        out = np.zeros(self.n, np.uint32 if self.bits > 16 else np.uint16)
        for plane in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[plane], count=self.n, bitorder="little").view(bool)
            before = np.empty_like(out)
            low, top, one = 0, self.zeros[plane], out.dtype.type(1 << (self.bits - 1 - plane))
            for i in range(0, self.n, STRETCH):
                own, part = bit[i : i + STRETCH], before[i : i + STRETCH]
                unset, set_ = np.flatnonzero(~own), np.flatnonzero(own)
                part[unset] = out[low : low + len(unset)]
                part[set_] = out[top : top + len(set_)] | one
                low, top = low + len(unset), top + len(set_)
            out = before
        return out


def _classes() -> np.ndarray:
    """The class of the character that ends at a byte, by that byte and the one before (as ``before << 8 | byte``).

    Inside a character, and for what may be white space or only Python's idea of it, no class says more than is sure.
    """
    own = np.full(256, _SOLID, np.uint8)
    own[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
    own[0x20] = _BLANK
    own[0x09:0x0E] = _BREAK
    own[0x1C:0x20] = _UNSURE
    own[0xC0:] = _LEAD
    own[[0xC2, 0xE1, 0xE2, 0xE3]] = _MAYBE_SPACE
    table = np.tile(own, (256, 1))
    # U+00C0 to U+027F and U+0400 to U+047F are letters, but for two signs of arithmetic.
    for lead in [*range(0xC3, 0xCA), 0xD0, 0xD1]:
        table[lead, 0x80:0xC0] = _LETTER
    table[0xC3, [0x97, 0xB7]] = _SOLID
    # Last two bytes of white space beyond ASCII.
    table[0xC2, 0x80:0xC0] = _UNSURE
    table[0x80, 0x80:0xC0] = _UNSURE
    table[[0x9A, 0x81, 0xA0], [0x80, 0x9F, 0x8E]] = _UNSURE
    return table.reshape(-1)


_UNSURE, _LETTER, _SOLID, _BLANK, _BREAK, _LEAD, _MAYBE_SPACE = range(7)
_CLASS = _classes()
_KIND, _SURE = _CLASS.tobytes(), (_LETTER, _SOLID)


def _pairs(left: list[int], right: list[int]) -> np.ndarray:
    table = np.zeros(64, bool)
    table[[8 * a + b for a in left for b in right]] = True
    return table


_AFTER_LETTER = _pairs([_LETTER], [_SOLID, _BLANK, _BREAK, _UNSURE])
_BEFORE_SPACE = _pairs([_LETTER, _SOLID], [_BLANK, _BREAK])
_AFTER_BREAK = _pairs([_BREAK], [_LETTER, _SOLID, _LEAD])
_AFTER_BLANK = _pairs([_BLANK], [_LETTER, _SOLID, _LEAD])


class Encoder:
    """A tokenizer file's ids of whole texts; units of a text met before are taken from the worker's store.

    Byte-level tokenizers split before a single space that stands between two other characters, so the parts between such
    places can be encoded one by one.  The usual pattern of the ByteLevel splitter also splits behind a letter that no letter follows, before any
    white space behind another character, and behind a single line break or tab; its texts are cut there too, which leaves fewer
    different units.  Texts that spell a special token are not cut.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spec = json.loads(definition)
        splitter = spec.get("pre_tokenizer") or {}
        plain = spec.get("normalizer") is None
        self.fine = plain and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space", True)
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.size = 0
        vocabulary = self.tokenizer.get_vocab()
        last = max(vocabulary.values(), default=0)
        self.bits = max(1, last.bit_length())
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        # A byte-level token has one character for each byte it spells.
        self.spelled = np.zeros(last + 1, np.int64)
        self.spelled[list(vocabulary.values())] = list(map(len, vocabulary))
        self.plain = plain

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian ids of each text; none for a null or empty one."""
        if self.size >= KEPT_BYTES // 2:
            self.older, self.kept, self.size = self.kept, {}, 0
        data, offsets = flat(texts)
        begin = self._units(data, offsets, texts)
        ends = pa.array(np.append(begin, len(data)), pa.int64())
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, ends.buffers()[1], pa.py_buffer(data)]).dictionary_encode()
        found = self._ids(units.dictionary.to_pylist())
        _, ends, made = pa.array(found, pa.large_binary()).take(units.indices).buffers()
        where = np.frombuffer(ends, np.int64)[np.searchsorted(begin, offsets)].tolist()
        raw = memoryview(made or b"")
        return [bytes(raw[a:b]) for a, b in zip(where, where[1:])]

    def _units(self, data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Where the units of some texts begin."""
        cut = np.zeros(len(data) + 1, bool)
        pair = data.astype(np.uint16)
        pair[1:] |= pair[:-1] << 8
        kind = _CLASS[pair]
        two = kind[:-1] << 3 | kind[1:]
        if self.fine:
            cut[1:-1] = (_AFTER_LETTER | _BEFORE_SPACE)[two]
            # A break behind a letter or a solid character is the first of its run of white space.
            cut[2:-1] |= _BEFORE_SPACE[two[:-1]] & _AFTER_BREAK[two[1:]]
        else:
            cut[1:-2] = _BEFORE_SPACE[two[:-1]] & _AFTER_BLANK[two[1:]]
        whole = np.zeros(len(offsets) - 1, bool)
        for content in self.special:
            whole |= pc.fill_null(pc.match_substring(texts, content), False).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(whole).tolist():
            cut[offsets[i] : offsets[i + 1]] = False
        cut[offsets] = True
        return np.flatnonzero(cut[:-1])

    def _ids(self, units: list[bytes]) -> list[bytes]:
        found = list(map(self.kept.get, units))
        missing = [i for i, f in enumerate(found) if f is None]
        if missing and self.older:
            for i in missing:
                found[i] = self.older.get(units[i])
                if found[i] is not None:
                    self._keep(units[i], found[i])
            missing = [i for i in missing if found[i] is None]
        if missing:
            # A space and what surely is no white space at both ends: such units can follow each other in one text.
            words, others = [], []
            for i in missing:
                u = units[i]
                joins = len(u) > 1 and u[0] == 0x20 and u[1] < 0x80 and _KIND[u[1]] in _SURE and _KIND[u[-2] << 8 | u[-1]] in _SURE
                (words if joins else others).append(u)
            for i in range(0, len(words), JOINED):
                self._encode_words(words[i : i + JOINED])
            self._encode_each(others)
            for i in missing:
                found[i] = self.kept[units[i]]
        return found

    def _encode_each(self, new: list[bytes]) -> None:
        for unit, made in zip(new, self.tokenizer.encode_batch_fast([u.decode() for u in new], add_special_tokens=False)):
            self._keep(unit, np.array(made.ids, self.kind).tobytes())

    def _encode_words(self, new: list[bytes]) -> None:
        """Units that may follow each other, in one text; its ids are cut where a unit's bytes are spelled."""
        made = np.array(self.tokenizer.encode_batch_fast([b"".join(new).decode()], add_special_tokens=False)[0].ids, self.kind)
        spelled = np.append(0, np.cumsum(self.spelled[made]))
        first = np.append(0, np.cumsum([len(u) for u in new]))
        cut = np.searchsorted(spelled, first)
        if not self.plain or spelled[-1] != first[-1] or (spelled[cut] != first).any():
            self._encode_each(new)
            return
        ids, places = made.tobytes(), (cut * self.kind().itemsize).tolist()
        for unit, a, b in zip(new, places, places[1:]):
            self._keep(unit, ids[a:b])

    def _keep(self, unit: bytes, ids: bytes) -> None:
        self.kept[unit] = ids
        self.size += ENTRY + len(unit) + len(ids)


_encoders: dict[int, Encoder] = {}


def _own(definition: str) -> Encoder:
    """The worker's encoder, so that units stored by one task serve the next."""
    key = hash(definition)
    if key not in _encoders:
        _encoders[key] = Encoder(definition)
    return _encoders[key]


SHARD = "part int, shard int, n_tokens long, doc_ids array<long>, lengths array<long>, matrix binary"


def write_shards(documents: DataFrame, tokenizer_path: str, path: str) -> None:
    """Encode every row's whole text, append END, and write the shards in ascending doc_id order to ``path``.

    Null and empty texts have END alone.  Rows without a doc_id come first; rows of one doc_id follow each other in the order of
    their texts.  An empty table writes no shard; other columns are ignored.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _own(definition)
        end = np.array([END], encoder.kind).tobytes()
        part, shard = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        docs: list[int | None] = []
        lengths: list[int] = []
        total = 0

        def close() -> pa.RecordBatch:
            nonlocal shard, total
            matrix = Matrix.build(np.frombuffer(b"".join(ids), encoder.kind), encoder.bits)
            row = [[part], [shard], [total], [docs], [lengths], [matrix.to_bytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "shard", "n_tokens", "doc_ids", "lengths", "matrix"])
            ids.clear(), docs.clear(), lengths.clear()
            shard, total = shard + 1, 0
            return out

        for piece in slices(batches, most=TOGETHER):
            for doc, made in zip(piece.column("doc_id").to_pylist(), encoder.encode(piece.column("text"))):
                ids += [made, end]
                docs.append(doc)
                lengths.append(len(made) // len(end) + 1)
                total += lengths[-1]
                if total >= SHARD_TOKENS:
                    yield close()
        if docs:
            yield close()

    ordered = documents.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SHARD).write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def _starts(shards: DataFrame) -> DataFrame:
    """(part, shard, base): tokens before each shard, from a running sum over parts and one inside each part."""
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    before = parts.withColumn("before", F.sum("all").over(Window.orderBy("part")) - F.col("all")).select("part", "before")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    return sizes.withColumn("inside", inside).join(before, "part").select("part", "shard", (F.col("before") + F.col("inside")).alias("base"))


def _per_document(shards: DataFrame, run, schema: str) -> DataFrame:
    made = shards.select("part", "shard", "doc_ids", "lengths", "matrix").mapInArrow(run, schema)
    return made.join(_starts(shards), ["part", "shard"])


def documents_of(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files: start counts the tokens of all
    documents before it, ids_crc32 is of its ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Matrix.from_bytes(row["matrix"]).sequence()
                begin = np.concatenate([[0], np.cumsum(row["lengths"])])
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(begin[:-1], begin[1:])]
                n = len(crc)
                columns = [[row["part"]] * n, [row["shard"]] * n, row["doc_ids"], begin[:-1], row["lengths"], crc]
                kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    rows = _per_document(shards, run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """(doc_id, position) of every occurrence of ``token``; positions count from the document's first token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = Matrix.from_bytes(row["matrix"])
                begin = np.concatenate([[0], np.cumsum(row["lengths"])])
                at = np.array([matrix.select(token, k) for k in range(matrix.rank(token, matrix.n))], np.int64)
                doc = np.searchsorted(begin, at, side="right") - 1
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][d] for d in doc], pa.int64()), pa.array(at - begin[doc])], ["doc_id", "position"])

    return shards.select("doc_ids", "lengths", "matrix").mapInArrow(run, "doc_id long, position long")


def count_tokens(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of ``tokens`` occurs, by one rank query per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("matrix").to_pylist():
                matrix = Matrix.from_bytes(blob)
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([matrix.rank(t, matrix.n) for t in tokens], pa.int64())], ["token", "n"])

    return shards.select("matrix").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
