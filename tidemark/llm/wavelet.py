"""Token ids in one wavelet matrix per shard.

A shard file holds consecutive documents: their ids and lengths, the sorted
alphabet of the shard and bit-planes of the symbols' ranks in it, highest bit
first, each plane stably parted by the bit above and preceded by the number of
its ones before every 512 bits. So any token is read, counted and located
without unpacking the file. Files are written by Spark's own writer, one file a
folder, whose name tells part, file, documents and tokens; a line feed ends
each file.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bytewords as bw
from tidemark.llm.common import bound_batches, running, shared_dir

MAGIC = b"TMWM0002"
HEAD = struct.Struct("<8sQQIIQ")  # magic, tokens, documents, planes, alphabet, spare
BLOCK = 512


@dataclass(frozen=True)
class TokenParams:
    """tokenizer: file of the tokenizers library; end_id closes each document.

    shard_tokens: a file is closed once it holds as many. docs_per_part: rows
    that one sorted partition is meant for; equal ids are parted by the first
    range_chars characters of their texts. cache_words: words whose ids a worker
    remembers.
    """

    tokenizer: str
    end_id: int = 1
    shard_tokens: int = 2 << 20
    docs_per_part: int = 8192
    range_chars: int = 64
    cache_words: int = 600_000


class WaveletMatrix:
    """Succinct sequence of token ids with access, rank, select, count and locate."""

    def __init__(self, n: int, alphabet: np.ndarray, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.alphabet, self.planes, self.zeros, self.ranks = n, alphabet, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        top = int(ids.max()) + 1 if n else 0
        if top <= 1 << 20:
            seen = np.zeros(top, bool)
            seen[ids] = True
            alphabet = np.flatnonzero(seen).astype(np.uint32)
            code = np.zeros(top, np.uint32)
            code[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
            x = code[ids]
        else:
            alphabet, x = np.unique(ids, return_inverse=True)
            alphabet = alphabet.astype(np.uint32)
        if len(alphabet) <= 1 << 16:
            x = x.astype(np.uint16)
        planes, zeros, ranks = [], [], []
        for b in range(max(1, (max(1, len(alphabet)) - 1).bit_length()) - 1, -1, -1):
            one = (x & x.dtype.type(1 << b)) != 0
            plane = np.zeros(-(-n // BLOCK) * (BLOCK // 8), np.uint8)
            packed = np.packbits(one, bitorder="little")
            plane[: len(packed)] = packed
            planes.append(plane)
            ranks.append(_block_ranks(plane))
            low, high = np.flatnonzero(~one), np.flatnonzero(one)
            zeros.append(len(low))
            x = np.concatenate([x[low], x[high]])
        return cls(n, alphabet, planes, zeros, ranks)

    def to_bytes(self) -> bytes:
        parts = [self.alphabet.astype("<u4").tobytes()]
        for plane, zero, ranks in zip(self.planes, self.zeros, self.ranks, strict=True):
            parts += [struct.pack("<Q", zero), ranks.astype("<u4").tobytes(), plane.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, n: int, bits: int, letters: int, data: memoryview) -> WaveletMatrix:
        alphabet = np.frombuffer(data, "<u4", letters)
        at, blocks = 4 * letters, -(-n // BLOCK)
        planes, zeros, ranks = [], [], []
        for _ in range(bits):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            ranks.append(np.frombuffer(data, "<u4", blocks + 1, at + 8))
            at += 8 + 4 * (blocks + 1)
            planes.append(np.frombuffer(data, np.uint8, blocks * (BLOCK // 8), at))
            at += blocks * (BLOCK // 8)
        return cls(n, alphabet, planes, zeros, ranks)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, rest = divmod(i, BLOCK)
        plane = self.planes[level]
        count = int(self.ranks[level][block])
        if rest:
            at = block * (BLOCK // 8)
            piece = plane[at : at + -(-rest // 8)]
            count += int(np.unpackbits(piece, bitorder="little")[:rest].sum())
        return count

    def _step(self, level: int, bit: int, i: int) -> int:
        one = self._ones(level, i)
        return self.zeros[level] + one if bit else i - one

    def access(self, i: int) -> int:
        """Token at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level, plane in enumerate(self.planes):
            bit = int(plane[i >> 3] >> (i & 7)) & 1
            code = code << 1 | bit
            i = self._step(level, bit, i)
        return int(self.alphabet[code])

    def _code(self, token: int) -> int | None:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def rank(self, token: int, i: int) -> int:
        """Occurrences of a token before position i."""
        code, a, b = self._code(token), 0, i
        if code is None:
            return 0
        for level in range(len(self.planes)):
            bit = code >> (len(self.planes) - 1 - level) & 1
            a, b = self._step(level, bit, a), self._step(level, bit, b)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence, from 0."""
        code = self._code(token)
        if code is None or not 0 <= k < self.count(token):
            raise IndexError(k)
        a = 0
        bits = [code >> (len(self.planes) - 1 - level) & 1 for level in range(len(self.planes))]
        for level, bit in enumerate(bits):
            a = self._step(level, bit, a)
        i = a + k
        for level in range(len(bits) - 1, -1, -1):
            if bits[level]:
                i = self._find(level, 1, i - self.zeros[level])
            else:
                i = self._find(level, 0, i)
        return i

    def _find(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th bit of a kind in a plane, by its rank blocks."""
        ones = self.ranks[level].astype(np.int64)
        kind = ones if bit else np.arange(len(ones), dtype=np.int64) * BLOCK - ones
        block = int(np.searchsorted(kind, k, "right")) - 1
        at = block * (BLOCK // 8)
        bits = np.unpackbits(self.planes[level][at : at + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(kind[block])])

    def locate(self, token: int) -> np.ndarray:
        """All positions of a token, ascending."""
        code, n = self._code(token), self.count(token)
        if code is None or n < 64:
            return np.array([self.select(token, k) for k in range(n)], np.int64)
        bits = [code >> (len(self.planes) - 1 - level) & 1 for level in range(len(self.planes))]
        a = 0
        for level, bit in enumerate(bits):
            a = self._step(level, bit, a)
        at = a + np.arange(n)
        for level in range(len(bits) - 1, -1, -1):
            plane = np.unpackbits(self.planes[level], count=self.n, bitorder="little")
            at = np.flatnonzero(plane == bits[level])[at - self.zeros[level] * bits[level]]
        return at

    def decode(self) -> np.ndarray:
        """All tokens, plane by plane from the last."""
        bits = len(self.planes)
        x = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            zero = self.zeros[level]
            y = np.empty_like(x)
            y[np.flatnonzero(~one)] = x[:zero]
            y[np.flatnonzero(one)] = x[zero:] | x.dtype.type(1 << (bits - 1 - level))
            x = y
        return self.alphabet[x]


def _block_ranks(plane: np.ndarray) -> np.ndarray:
    ones = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.int64)
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(ones)])


def pack(doc_ids: np.ndarray, known: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """Image of a shard file; ``known`` is false where a document's id is null."""
    if len(ids) >= 1 << 32:
        raise ValueError("too many tokens in a shard")
    matrix = WaveletMatrix.build(ids)
    head = HEAD.pack(MAGIC, len(ids), len(sizes), len(matrix.planes), len(matrix.alphabet), 0)
    return b"".join([head, doc_ids.astype("<i8").tobytes(), known.astype(np.uint8).tobytes(), sizes.astype("<i8").tobytes(), matrix.to_bytes()])


def unpack(data: bytes | memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray, WaveletMatrix]:
    """Document ids, whether they are known, lengths and the matrix of a shard file."""
    view = memoryview(data)
    magic, n, docs, bits, letters, _ = HEAD.unpack_from(view)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    if n >= 1 << 32:
        raise ValueError("too many tokens in a shard")
    at = HEAD.size
    doc_ids = np.frombuffer(view, "<i8", docs, at)
    known = np.frombuffer(view, np.uint8, docs, at + 8 * docs).astype(bool)
    sizes = np.frombuffer(view, "<i8", docs, at + 9 * docs)
    return doc_ids, known, sizes, WaveletMatrix.from_bytes(n, bits, letters, view[at + 17 * docs :])


def _byte_letters() -> list[str]:
    """Letter that stands for each byte in byte-level vocabularies: itself where it prints, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def _byte_kinds() -> np.ndarray:
    """1: letters (ASCII, and the bytes of U+00C0 to U+00FF), 2: digits, 3: other ASCII signs, 0: white space, 4: anything else."""
    kind = np.full(256, 4, np.uint8)
    kind[33:127] = 3
    kind[48:58] = 2
    kind[65:91] = kind[97:123] = kind[128:192] = kind[0xC3] = 1
    kind[39] = 4  # an apostrophe may join the letters after it
    kind[[9, 10, 11, 12, 13, 32]] = 0
    return kind


# How the vocabulary file that the quick way of encoding is made for normalises and cuts texts.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
CUTTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def cuts_as_known(path: str) -> bool:
    """Whether a tokenizer's file has the rules that :class:`Encoder` can do without the library."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    # of these signs only "<|" may begin an added token
    plain = all(t["content"].startswith("<|") and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in rules["added_tokens"])
    model = rules["model"]
    whole = model["type"] == "BPE" and not (model["dropout"] or model["unk_token"] or model["continuing_subword_prefix"] or model["byte_fallback"])
    return plain and whole and rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == CUTTER and rules["post_processor"] is None


class Encoder:
    """Tokenizer with a memory of words and their parts.

    This holds for files with the rules above (:func:`cuts_as_known`); with any
    other file each text goes through the library as a whole.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its words in turn. A word of plain signs (ASCII but for
    apostrophes and control characters, and Latin letters up to U+00FF) is cut
    where the tokenizer cuts it too: into runs of letters, single digits and
    runs of other signs, each lower-cased and handed to the tokenizer's model.
    Any other word goes through the whole tokenizer. A worker remembers the ids
    of each part by a 64-bit hash.
    """

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.tok, self.limit = Tokenizer.from_file(path), limit
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model, self.quick = self.tok.model, cuts_as_known(path)
        self.kinds, self.lower = _byte_kinds(), bw.lower_table()
        self.letters = dict(enumerate(_byte_letters()))
        self.clear()

    def clear(self) -> None:
        self.known, self.slot, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int32), 0
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(8192, np.uint32), 0

    def _keep(self, ids: list[int]) -> None:
        at = self.count
        if at == len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.start[at], self.size[at] = self.used, len(ids)
        self.used += len(ids)
        self.count += 1

    def _parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes in lower case, starts and ends of parts, whether each is a word as it stands, and the parts before each text."""
        kind = self.kinds[data]
        starts, ends, _ = bw.spans(kind > 0, offsets)
        odd = kind == 4
        lead = np.flatnonzero(data == 0xC3)
        follow = data[np.minimum(lead + 1, len(data) - 1)]
        odd[lead[(follow == 0x97) | (follow == 0xB7)]] = True  # the two signs among these letters
        special = np.flatnonzero(data == 60)
        odd[special[data[np.minimum(special + 1, len(data) - 1)] == 124]] = True  # "<|" may begin a special token
        low = self.lower[data]
        low[lead[(follow >= 0x80) & (follow <= 0x9E)] + 1] += 0x20
        whole = np.zeros(len(starts), bool)
        whole[np.searchsorted(starts, np.flatnonzero(odd), "right") - 1] = True
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts[whole]] = 1
        inside[ends[whole]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        low = np.where(inside, data, low)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        cut[:-1] &= ~inside & (kind > 0)
        cut[starts] = True
        a = np.flatnonzero(cut)
        stop = np.append(a[1:], len(data))
        of = np.searchsorted(starts, a, "right") - 1
        return low, a, np.minimum(stop, ends[of]), whole[of], np.searchsorted(a, offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and their number in each."""
        if not self.quick:
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            ids = [[*e.ids, end_id] for e in self.tok.encode_batch(texts, add_special_tokens=False)]
            return np.array([i for of in ids for i in of], np.uint32), np.array([len(of) for of in ids], np.int64)
        if self.count > self.limit:
            self.clear()
        low, starts, ends, whole, before = self._parts(data, offsets)
        hashes = bw.word_hashes(low, starts, ends) ^ np.where(whole, np.uint64(0x9E6C63D0876A9A47), np.uint64(0))
        found, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.known, found)
        seen = self.known[np.minimum(spot, len(self.known) - 1)] == found if len(self.known) else np.zeros(len(found), bool)
        new = np.flatnonzero(~seen)
        if len(new):
            raw, one, fresh = low.tobytes(), first[new], self.count
            tokenize, letters = self.model.tokenize, self.letters
            for a, b, w in zip(starts[one].tolist(), ends[one].tolist(), whole[one].tolist(), strict=True):
                if w:
                    self._keep(self.tok.encode(raw[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids)
                else:
                    self._keep([t.id for t in tokenize(raw[a:b].decode("latin-1").translate(letters))])
            self.slot = np.insert(self.slot, spot[new], np.arange(fresh, self.count, dtype=np.int32))
            self.known = np.insert(self.known, spot[new], found[new])
            spot = np.searchsorted(self.known, found)
        at = self.slot[spot]
        size = self.size[at][which]
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        per = total[before[1:]] - total[before[:-1]] + 1
        out = np.full(int(per.sum()), end_id, np.uint32)
        put = np.ones(len(out), bool)
        put[np.cumsum(per) - 1] = False
        source = np.repeat(self.start[at][which] - total[:-1], size) + np.arange(total[-1])
        out[np.flatnonzero(put)] = self.pool[source]
        return out, per


@lru_cache(maxsize=2)
def _encoder(path: str, limit: int) -> Encoder:
    return Encoder(path, limit)


_FILES = "part int, file int, docs long, tokens long, image binary"
_DOCS = "part int, file int, nth long, doc_id long, n_tokens long, ids_crc32 long"


def write_shards(docs: DataFrame, params: TokenParams, path: str | None = None) -> DataFrame:
    """Write shard files below ``path``, by default a new folder in the shared one, and return :func:`open_shards` of them.

    Documents are put in ranges of doc_id, null ids first, equal ids by text;
    within a range a file is closed at the first document that fills it. Null
    and empty texts are the end id alone. An empty table gives no files.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    path = path or f"{shared_dir(spark)}/token-shards-{uuid.uuid4().hex}"
    parts = max(1, -(-docs.count() // params.docs_per_part))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # a prefix orders texts as they are ordered themselves
    rows = rows.repartitionByRange(parts, "doc_id", F.substring("text", 1, params.range_chars)).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, file = _encoder(params.tokenizer, params.cache_words), TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            nonlocal held, file
            ids, known, sizes, tokens = (np.concatenate(x) for x in zip(*held, strict=True))
            image = pack(ids, known, sizes, tokens)
            held, file = [], file + 1
            columns = [pa.array([part], pa.int32()), pa.array([file - 1], pa.int32()), pa.array([len(sizes)], pa.int64()), pa.array([len(tokens)], pa.int64()), pa.array([image], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "file", "docs", "tokens", "image"])

        for batch in batches:
            known = np.asarray(batch.column(0).is_valid().to_numpy(zero_copy_only=False), bool)
            doc_ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            raw, offsets = bw.buffers(batch.column(1))
            for a, b, data, at in bw.chunks(raw, offsets):
                tokens, sizes = encoder.encode(data, at, params.end_id)
                held.append((doc_ids[a:b], known[a:b], sizes, tokens))
                if sum(len(h[3]) for h in held) >= params.shard_tokens:
                    yield close()
        if held:
            yield close()

    # the text writer puts the bytes of a string as they are, and a line feed after them
    images = rows.mapInArrow(run, _FILES).withColumn("image", F.col("image").cast("string"))
    images.write.partitionBy("part", "file", "docs", "tokens").text(path)
    return open_shards(spark, path)


def open_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shard files below a folder: path, part, file, docs, tokens and content, which is only read where it is used."""
    files = spark.read.format("binaryFile").load(path)
    if "part" not in files.columns:  # no file was written
        return spark.createDataFrame([], "path string, part int, file int, docs long, tokens long, content binary")
    return files.select("path", *[F.col(c).cast("int").alias(c) for c in ("part", "file")], *[F.col(c).cast("long").alias(c) for c in ("docs", "tokens")], "content")


def starts(files: DataFrame) -> DataFrame:
    """(part, file, base): how many tokens lie before each file."""
    inner = running(files.select("part", "file", "tokens"), ["part"], "file", "tokens", "_in").drop("tokens")
    outer = running(files.groupBy("part").agg(F.sum("tokens").alias("_n")), [], "part", "_n", "_out").drop("_n")
    return inner.join(outer, "part").select("part", "file", (F.col("_in") + F.col("_out")).alias("base"))


def read_shards(files: DataFrame) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    bound_batches(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, file, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                doc_ids, known, sizes, matrix = unpack(image.as_buffer())
                ids = memoryview(matrix.decode().astype("<u4").tobytes())
                ends = np.cumsum(sizes) * 4
                crc = [zlib.crc32(ids[e - 4 * s : e]) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                n = len(sizes)
                columns = [np.full(n, part, np.int32), np.full(n, file, np.int32), np.cumsum(sizes) - sizes, None, sizes, np.array(crc, np.int64)]
                arrays = [pa.array(doc_ids, mask=~known) if c is None else pa.array(c) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "file", "nth", "doc_id", "n_tokens", "ids_crc32"])

    rows = files.select("part", "file", "content").mapInArrow(run, _DOCS)
    return rows.join(starts(files), ["part", "file"]).select("doc_id", (F.col("base") + F.col("nth")).alias("start"), "n_tokens", "ids_crc32")


def _asked(files: DataFrame, answer, schema: str) -> DataFrame:
    """Rows that ``answer`` (matrix, base) gives as lists of columns for each file; files are not decoded."""
    bound_batches(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, image in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                columns = answer(unpack(image.as_buffer())[3], base)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in schema.split(", ")])

    return files.join(starts(files), ["part", "file"]).select("base", "content").mapInArrow(run, schema)


def token_counts(files: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of a few tokens occurs in all files, by rank."""
    rows = _asked(files, lambda m, base: (tokens, [m.count(t) for t in tokens]), "token long, n long")
    return rows.groupBy("token").agg(F.sum("n").alias("n"))


def token_positions(files: DataFrame, token: int) -> DataFrame:
    """(at): all positions of a token in the sequence of all files, by select."""
    return _asked(files, lambda m, base: (m.locate(token) + base,), "at long")


def tokens_at(files: DataFrame, places: list[int]) -> DataFrame:
    """(at, token) of a few positions in the sequence of all files, by access; places beyond its end are left out."""

    def answer(m: WaveletMatrix, base: int) -> tuple[list[int], list[int]]:
        here = [p for p in places if base <= p < base + m.n]
        return here, [m.access(p - base) for p in here]

    return _asked(files, answer, "at long, token long")
