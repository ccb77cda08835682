"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A shard holds the records of one range of ``doc_id``; shard numbers ascend with it. Layout, little-endian:

* header: ``RLTOKENS``, u16 version, u16 bytes per id (2 or 4), u32 zero;
* record: u64 payload length, u32 masked CRC-32 of those eight bytes, payload, u32 masked CRC-32 of the payload;
* payload: u8 (1 if the row has a doc_id), i64 doc_id, the ids;
* index file: u64 offset of every record, then the offset of the file's end.

The mask rotates a checksum right by 15 bits and adds a constant, so that a checksum of data that holds
checksums stays sound. A shard is written under a name of its attempt and renamed when complete: a repeated
task replaces it by the same bytes.

Rows: NULL and empty texts become the end id alone; rows without doc_id come first; rows that share a doc_id
are ordered by text; other columns are ignored, whatever their names; an empty table gives no shard.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from rosterline.llm.common import buffers, file_system, located_words, not_blank, prepare, ragged, slices, tidy
from rosterline.session import fresh_path

MAGIC = b"RLTOKENS"
HEADER = struct.Struct("<8sHHI")
FRAME = struct.Struct("<QI")
CACHED_WORDS = 1_500_000
CACHED_SIGNS = 10_000
READ_BYTES = 1 << 22

# The pattern by which the tokenizer cuts text, and the bytes that its alphabet shows as themselves.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]

VISIBLE = {byte: 256 + k for k, byte in enumerate(b for b in range(256) if b not in SHOWN)}
# ASCII signs but the apostrophe, and words of letters that are their own composed form.
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and c != 39)
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]*")

MANIFEST = "shard long, path string, records long, tokens long"
RECORDS = "shard long, ordinal long, doc_id long, start long, n_tokens long, ids_crc32 long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


class WordEncoder:
    """Ids of texts, remembering those of words parted by ASCII blanks.

    The tokenizer turns runs of blanks into one space and drops it, and no piece of its pattern spans one, so
    a text's ids are those of its blank-parted words in turn; plain words go to the BPE model without the steps before it.
    Words are known by 64-bit hashes in a sorted array, looked up once per slice. When more than ``CACHED_WORDS`` are
    remembered, the memory starts anew.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.plain = self._cuts_plain_words()
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.values = not_blank(fold=False)
        self.forget()

    def _cuts_plain_words(self) -> bool:
        """Whether the tokenizer lower-cases and cuts words of letters and signs as ``_ids`` does."""
        made = json.loads(self.tokenizer.to_str())
        splits = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [x.get("type") for x in (made.get("normalizer") or {}).get("normalizers") or []]
        return kinds == ["NFC", "Replace", "Lowercase"] and splits[0].get("pattern") == {"Regex": WORD_PATTERN}

    def forget(self) -> None:
        self.signs: dict[str, bytes] = {}
        self.known = np.empty(0, np.uint64)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int32)
        self.pool = np.empty(1 << 16, self.dtype)
        self.used = 0

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _ids(self, word: bytes) -> bytes:
        """The packed ids of a word. One of letters, then ASCII signs other than the apostrophe, is cut there; the pattern does so as well."""
        text = word.decode("utf-8", "replace")
        letters = text.rstrip(SIGNS) if self.plain else "\0"
        if not (letters.isascii() and letters.isalpha() or LETTERS.fullmatch(letters)):
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        signs = text[len(letters) :]
        letters = letters.lower()
        mapped = letters if letters.isascii() else letters.encode().decode("latin-1").translate(VISIBLE)
        ids = self._packed([t.id for t in self.model.tokenize(mapped)]) if letters else b""
        if not signs:
            return ids
        ending = self.signs.get(signs)
        if ending is None:
            ending = self._packed(self.tokenizer.encode(signs, add_special_tokens=False).ids)
            if len(self.signs) < CACHED_SIGNS:
                self.signs[signs] = ending
        return ids + ending

    def _learn(self, hashes: np.ndarray, found: list[bytes]) -> None:
        """Add words by their sorted hashes."""
        packed = [self._ids(word) for word in found]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(packed), self.dtype)
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.lengths = np.insert(self.lengths, place, sizes)
        self.starts = np.insert(self.starts, place, self.used + np.cumsum(sizes) - sizes)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of a slice, one after the other, and where each row's begin and the last one's end."""
        hashes, begin, end, at = located_words(data, offsets, self.values)
        if len(hashes) == 0:
            return np.empty(0, self.dtype), np.zeros(len(at), np.int64)
        if len(self.known) > CACHED_WORDS:
            self.forget()
        different, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, different)
        new = np.append(self.known, np.uint64(0))[place] != different
        new |= place == len(self.known)
        if new.any():
            self._learn(different[new], [data[b:e].tobytes() for b, e in zip(begin[first[new]].tolist(), end[first[new]].tolist())])
            place = np.searchsorted(self.known, different)
        lengths = self.lengths[place][which].astype(np.int64)
        ids = self.pool[ragged(self.starts[place][which], lengths)]
        return ids, np.append(0, np.cumsum(lengths))[at]

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of one whole text."""
        return self.encode_rows(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer_path: str) -> WordEncoder:
    """One encoder per worker process; its memory of words ends with a task."""
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = WordEncoder(tokenizer_path)
    return _ENCODERS[tokenizer_path]


@tidy
def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer_path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer_path)
    width = encode.dtype.itemsize
    end_mark = np.array([end_id], encode.dtype)
    shard = TaskContext.get().partitionId()
    fs, root = file_system(folder)
    name, attempt = f"{root}/part-{shard:06d}", uuid.uuid4().hex
    stream, offsets, at, tokens = None, [], HEADER.size, 0
    for batch in batches:
        ids_of_docs, texts = batch.column(0), batch.column(1)
        data, bounds = buffers(texts)
        for first, last in slices(bounds):
            flat, places = encode.encode_rows(data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
            out = bytearray()
            for row in range(first, last):
                ids = flat[places[row - first] : places[row - first + 1]]
                doc_id = ids_of_docs[row].as_py()
                payload = struct.pack("<Bq", doc_id is not None, doc_id or 0) + ids.tobytes() + end_mark.tobytes()
                size = struct.pack("<Q", len(payload))
                record = size + struct.pack("<I", masked_crc(size)) + payload + struct.pack("<I", masked_crc(payload))
                offsets.append(at)
                at += len(record)
                tokens += len(ids) + 1
                out += record
            if stream is None:
                stream = fs.open_output_stream(f"{name}.rec.{attempt}")
                stream.write(HEADER.pack(MAGIC, 1, width, 0))
            stream.write(bytes(out))
    encode.forget()
    if stream is not None:
        stream.close()
        with fs.open_output_stream(f"{name}.idx.{attempt}") as index:
            index.write(np.array([*offsets, at], "<u8").tobytes())
        for kind in ("rec", "idx"):
            fs.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "path": [f"{folder}/part-{shard:06d}"], "records": [len(offsets)], "tokens": [tokens]},
            schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("records", pa.int64()), ("tokens", pa.int64())]),
        )


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Encode whole texts and write them in ascending doc_id order; returns the stored list of shards.

    ``folder`` is on a store that all executors share. The one shuffle moves each text once.
    """
    spark = prepare(docs.sparkSession)
    fs, root = file_system(folder)
    fs.create_dir(f"{root}/shards", recursive=True)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(lambda batches: _write_shard(batches, f"{folder}/shards", tokenizer_path, end_id), MANIFEST)
    shards.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_record(stream, offset: int, size: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset, as in a shuffled read; ``size`` is the file's bytes per id."""
    stream.seek(offset)
    length, crc = FRAME.unpack(stream.read(FRAME.size))
    if masked_crc(struct.pack("<Q", length)) != crc:
        raise ValueError(f"damaged length at {offset}")
    payload = stream.read(length)
    if len(payload) != length or masked_crc(payload) != struct.unpack("<I", stream.read(4))[0]:
        raise ValueError(f"damaged record at {offset}")
    known, doc_id = struct.unpack_from("<Bq", payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{size}", offset=9)


def open_shard(path: str):
    """The open shard, its bytes per id, and its offsets."""
    fs, local = file_system(path)
    stream = fs.open_input_file(f"{local}.rec")
    magic, version, width, _ = HEADER.unpack(stream.read(HEADER.size))
    if magic != MAGIC or version != 1:
        raise ValueError(f"not a shard: {path}")
    with fs.open_input_stream(f"{local}.idx") as index:
        offsets = np.frombuffer(index.read(), "<u8")
    return stream, width, offsets


@tidy
def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, path, records, start in zip(*(batch.column(i).to_pylist() for i in range(4))):
            stream, width, offsets = open_shard(path)
            if len(offsets) != records + 1:
                raise ValueError(f"index of {path} has {len(offsets) - 1} records, not {records}")
            rows = []
            for ordinal in range(records):
                doc_id, ids = read_record(stream, int(offsets[ordinal]), width)
                rows.append((shard, ordinal, doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
                if len(rows) == 4096 or ordinal == records - 1:
                    yield _rows(rows)
                    rows = []
            stream.close()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], names)


def read_records(shards: DataFrame) -> DataFrame:
    """Read every shard back, checking all checksums: one row per document, ``start`` counted over all shards."""
    # One row per shard: a window over it stays small however many documents there are.
    listed = shards.selectExpr(
        "shard", "path", "records",
        "coalesce(sum(tokens) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base",
    )
    tasks = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.repartition(tasks, "shard").mapInArrow(_read_shards, RECORDS)


def write_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    folder = fresh_path(docs.sparkSession, "token-records")
    return read_records(write_records(docs, folder, tokenizer_path, end_id))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_and_read(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_file())
