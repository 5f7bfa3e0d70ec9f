"""Token ids in binary files, whose document boundaries are Elias-Fano codes with select."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from coverspark.llm.texts import give_back
from coverspark.llm.tokens import Encoder, _library, groups, vocabulary
from coverspark.session import cut, scratch_path, ship

#: A file, all numbers little-endian: _HEAD; the documents' ids without the nulls, which come first, less the first of them
#: (Elias-Fano); the ends of all documents in the array (Elias-Fano); the array of token ids; a line feed.
_HEAD = struct.Struct("<8sQqQQQB7x")  # magic, number of the file, first document's id, null ids, documents, token ids, bytes per token id
_MAGIC = b"TOKENEF1"
_PART = struct.Struct("<QQB7x")  # numbers, bytes of the high bits, low bits of each number
#: Every so many numbers the place of its high bit is kept; select starts there.
_EVERY = 256


@dataclass(frozen=True)
class EliasFano:
    """n numbers below 2**64 that never fall, in at most 2 + log2(largest / n) bits each and 1/8 of a bit for select.

    The `low_bits` lowest bits of each are in an array. What is above them is in `high`, in unary: number i sets the bit at
    (number >> low_bits) + i. `samples` holds the place of every 256th set bit, in 32 bits.
    """

    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: np.ndarray

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        x = np.asarray(numbers, np.uint64)
        n, last = len(x), int(x[-1]) if len(x) else 0
        bits = max(0, (last // n).bit_length() - 1) if n else 0
        at = ((x >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        low = []
        if bits:
            for a in range(0, n, 1 << 16):  # whole bytes, as the step is a multiple of 8
                part = x[a : a + (1 << 16), None] >> np.arange(bits, dtype=np.uint64)
                low.append(np.packbits((part & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes())
        return cls(n, bits, b"".join(low), np.packbits(high, bitorder="little").tobytes(), at[::_EVERY].astype("<u4"))

    def __getitem__(self, i: int) -> int:
        """Number i, by select: from the sample before it over the bytes up to its bit."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, missing = int(self.samples[i // _EVERY]), i % _EVERY
        byte, width = place >> 3, 64
        skip = (self.high[byte] & ((1 << (place & 7)) - 1)).bit_count()
        missing += skip
        while True:
            counts = np.cumsum(np.bitwise_count(np.frombuffer(self.high, np.uint8, min(width, len(self.high) - byte), byte)))
            if counts[-1] > missing:
                break
            missing -= int(counts[-1])
            byte, width = byte + len(counts), width * 2
        k = int(np.searchsorted(counts, missing, "right"))
        missing -= int(counts[k - 1]) if k else 0
        value = self.high[byte + k]
        for _ in range(missing):
            value &= value - 1
        place = ((byte + k) << 3) + (value & -value).bit_length() - 1
        first = i * self.low_bits
        held = int.from_bytes(self.low[first >> 3 : (first + self.low_bits + 7) >> 3], "little")
        return ((place - i) << self.low_bits) | (held >> (first & 7)) & ((1 << self.low_bits) - 1)

    def numbers(self) -> np.ndarray:
        """All of them at once."""
        place = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        out = (place - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        for a in range(0, self.n if self.low_bits else 0, 1 << 16):
            n = min(1 << 16, self.n - a)
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8, -(-n * self.low_bits // 8), a * self.low_bits // 8), bitorder="little", count=n * self.low_bits)
            out[a : a + n] |= (bits.reshape(n, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return out

    def first_from(self, number: int) -> int:
        """The first place whose number is `number` or more; n if there is none."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            if self[mid] < number:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def to_bytes(self) -> bytes:
        return _PART.pack(self.n, len(self.high), self.low_bits) + self.low + self.high + self.samples.tobytes()

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        """The code that starts at this byte, and the byte after it."""
        n, high, bits = _PART.unpack_from(data, at)
        a = at + _PART.size
        b = a + -(-n * bits // 8)
        c = b + high
        d = c + 4 * -(-n // _EVERY)
        return cls(n, bits, data[a:b], data[b:c], np.frombuffer(data, "<u4", -(-n // _EVERY), c)), d


def file_bytes(number: int, doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """One file, without its line feed. doc_ids ascend, nulls first; ids has each document's token ids."""
    nulls = sum(i is None for i in doc_ids)
    first = doc_ids[nulls] if nulls < len(doc_ids) else 0
    names = EliasFano.of(np.array([i - first for i in doc_ids[nulls:]], np.uint64))
    ends = EliasFano.of(np.cumsum([len(x) for x in ids], dtype=np.uint64))
    flat = np.concatenate([np.empty(0, np.uint32), *ids]).astype(f"<u{width}")
    return b"".join((_HEAD.pack(_MAGIC, number, first, nulls, len(doc_ids), len(flat), width), names.to_bytes(), ends.to_bytes(), flat.tobytes()))


@dataclass(frozen=True)
class TokenFile:
    """A file that has been read: document k (from 0) is doc_id(k), its token ids are ids(k)."""

    number: int
    nulls: int
    first: int
    names: EliasFano
    ends: EliasFano
    flat: np.ndarray

    @classmethod
    def read(cls, data: bytes) -> TokenFile:
        magic, number, first, nulls, docs, n, width = _HEAD.unpack_from(data)
        names, at = EliasFano.read(data, _HEAD.size)
        ends, at = EliasFano.read(data, at)
        if magic != _MAGIC or ends.n != docs or names.n + nulls != docs or len(data) < at + n * width:
            raise ValueError("not a whole file of token ids")
        return cls(number, nulls, first, names, ends, np.frombuffer(data, f"<u{width}", n, at))

    def doc_id(self, k: int) -> int | None:
        return None if k < self.nulls else self.first + self.names[k - self.nulls]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.first + i for i in self.names.numbers().tolist()]

    def start(self, k: int) -> int:
        return self.ends[k - 1] if k else 0

    def ids(self, k: int) -> np.ndarray:
        return self.flat[self.start(k) : self.ends[k]]

    def places(self, low: int, high: int) -> range:
        """Documents with low <= id <= high."""
        found = (self.names.first_from(max(0, i - self.first)) for i in (low, high + 1))
        a, b = (self.nulls + k for k in found)
        return range(a, b)


#: A-Z to lower case; then what ends a word, and a unit, in the text that the faster library sees. Bytes of units that it may see: printable ASCII, white
#: space, and letters from U+00C0 to U+017F, whose lower case and composition are the same everywhere.
_LOWER = bytes(k + 32 if 65 <= k <= 90 else k for k in range(256))
_WORD_END, _UNIT_END = "\x01", "\x02"
_PLAIN = bytes(k for k in range(256) if 32 <= k <= 126 or k in b"\t\n\r\x0b\x0c" or 0x80 <= k <= 0xBF or 0xC3 <= k <= 0xC5)


def _byte_signs() -> dict[str, int]:
    """The printable sign that byte-level vocabularies write for each byte: itself if printable, else the next beyond U+00FF."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [k for k in range(256) if k not in own]
    return {chr(k): k for k in own} | {chr(256 + n): k for n, k in enumerate(rest)}


@lru_cache(maxsize=2)
def _word_library(name: str):
    """A word-level vocabulary, its word ends written as a byte, for the `tiktoken` library, and the pattern of its words.

    None unless the file is one of byte-level merges with word ends in the order of their ids, over lower-cased text without white space.
    """
    with open(vocabulary(name)) as f:
        own = json.load(f)
    model, parts = own["model"], own["pre_tokenizer"] or {}
    split, *after = parts.get("pretokenizers", [{}])
    kinds = [n["type"] for n in (own["normalizer"] or {}).get("normalizers", [])]
    ends = model.get("end_of_word_suffix")
    if kinds != ["NFC", "Replace", "Lowercase"] or split.get("type") != "Split" or not split.get("invert") or [p["type"] for p in after] != ["ByteLevel"] or not ends:
        return None
    signs, ranks = _byte_signs(), {}
    for token, k in model["vocab"].items():
        word = token.removesuffix(ends)
        if set(word) <= signs.keys():
            ranks[bytes(signs[c] for c in word) + _WORD_END.encode() * (word != token)] = k
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    first = [ranks.get(bytes([k]) + e) for k in range(256) for e in (b"", _WORD_END.encode())]
    if None in first or made != sorted(made) or max(first) >= made[0]:
        return None
    words = regex.compile(split["pattern"]["Regex"].replace("[^", f"[^{_UNIT_END}"))
    return tiktoken.Encoding(name, pat_str=rf"[^{_WORD_END}{_UNIT_END}\s]+{_WORD_END}|{_UNIT_END}", mergeable_ranks=ranks, special_tokens={}), words, ranks[_UNIT_END.encode()]


class WordEncoder(Encoder):
    """An Encoder for word-level vocabularies: new units of plain Latin text go through the faster library, many at a time.

    Those are lower-cased and split as the vocabulary says, each word with a mark at its end, as its last token has. Others,
    those with control characters and those that may hold special tokens go through the vocabulary's own library. A-Z are
    lower-cased before units are told apart, but in texts that may hold special tokens, or marks that compose with lower-case
    letters only. Holds 400,000 units and those of one call.
    """

    def __init__(self, name: str):
        self.words = _word_library(name)
        super().__init__(name)

    def _forget(self) -> None:
        if len(getattr(self, "known", ())) > 400_000 or not hasattr(self, "known"):
            super()._forget()

    def encode_bytes(self, texts: list[bytes]) -> list[np.ndarray]:
        return super().encode_bytes([t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.translate(_LOWER) for t in texts] if self.words else texts)

    def _learn(self, units: list[bytes]) -> None:
        if self.words:
            encoding, words, mark = self.words
            plain = [u for u in units if not u.translate(None, _PLAIN) and b"<|" not in u]
            for a in range(0, len(plain), 1 << 15):
                part = plain[a : a + (1 << 15)]
                text = _UNIT_END.encode().join([*part, b""]).decode("utf-8").lower()
                ids = encoding.encode_to_numpy(words.sub(rf"\g<0>{_WORD_END}", text)).astype(np.uint32)
                marks = ids == mark
                self._add(part, ids[~marks], np.flatnonzero(marks) - np.arange(len(part)))
            units = [u for u in units if u not in self.known]
        super()._learn(units)


def _written(name: str, end_id: int, most: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base, made = WordEncoder(name), TaskContext.get().partitionId() << 32, 0
        names, ids, total = [], [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([file_bytes(base + made, names, ids, width)], pa.binary())], names=["content"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts, keys = part.column(1).to_pylist(), part.column(0).to_pylist()
                for a, b in groups(texts):
                    for key, got in zip(keys[a:b], own.encode(texts[a:b])):
                        names.append(key)
                        ids.append(np.append(got, np.uint32(end_id)))
                        total += len(ids[-1])
                        if total >= most:
                            yield close()
                            names, ids, total, made = [], [], 0, made + 1
        if names:
            yield close()
        del own
        give_back()

    return run


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", name: str = "word_bpe_49k.json", end_id: int = 1, file_ids: int = 1 << 22) -> None:
    """Write the token ids of all documents, `end_id` after each, to binary files in `folder`, by ascending document id.

    Whole texts (null: empty) as the vocabulary `name` gives them without added tokens, so every document has one id at least.
    Document ids are whole numbers; null ids come first; rows with one id are ordered by a hash of their text, equal rows
    in any order; none is left out. Other columns are ignored; an empty table gives no file with content. A file is closed
    once it holds `file_ids` token ids, so it is as large as that and its last document, 2 bytes an id where the
    vocabulary allows and 4 otherwise. Files are numbered in the order of the documents.

    One range shuffle of the texts; encoding, coding and writing are one stage, whose files appear when it is done. The
    line writer of Spark puts each file's bytes, as they are, on any storage that Spark knows.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be a whole number, to be coded as an ascending sequence")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    order = [F.col("_id"), F.xxhash64("_text")]
    width = 2 if max(end_id, _largest(name)) < 1 << 16 else 4
    files = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_written(name, end_id, file_ids, width), "content binary")
    files.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)


def _largest(name: str) -> int:
    return _library(name).get_vocab_size(with_added_tokens=True) - 1


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where("length > 1").select("content")


def read_boundaries(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (token ids of all documents before it), n_tokens, ids_crc32.

    ids_crc32 is the unsigned crc32 of its ids as little-endian unsigned 32-bit integers. The files are read once; sums over
    files, one row each, turn places in a file into places in the whole.
    """
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                own = TokenFile.read(content.as_py())
                ends = own.ends.numbers().astype(np.int64)
                starts = np.r_[0, ends[:-1]]
                data = memoryview(own.flat.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                made = (np.full(len(ends), own.number), own.doc_ids(), starts, ends - starts, crc)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], names=["file", "doc_id", "at", "n_tokens", "ids_crc32"])
        give_back()

    rows = cut(_files(spark, folder).mapInArrow(run, "file long, doc_id long, at long, n_tokens long, ids_crc32 long"))
    sizes = rows.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    before = sizes.select("file", F.coalesce(F.sum("_n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.join(before, "file").select("doc_id", (F.col("_before") + F.col("at")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, folder: str, low: int, high: int) -> DataFrame:
    """(doc_id, ids array<long>) of the documents with low <= doc_id <= high, found by select; no other boundary is decoded."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                own = TokenFile.read(content.as_py())
                for k in own.places(low, high):
                    ids = pa.array([own.ids(k).astype(np.int64)], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([own.doc_id(k)], pa.int64()), ids], names=["doc_id", "ids"])
        give_back()

    return _files(spark, folder).mapInArrow(run, "doc_id long, ids array<long>")


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "word_bpe_49k.json", end_id: int = 1, file_ids: int = 1 << 22) -> DataFrame:
    """write_token_files to a new folder of the shared ones, and read_boundaries of it, with the id under its own name."""
    spark = docs.sparkSession
    folder = scratch_path(spark)
    write_token_files(docs, folder, id_col, text_col, name, end_id, file_ids)
    return read_boundaries(spark, folder).withColumnRenamed("doc_id", id_col)
