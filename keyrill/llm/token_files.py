"""Token ids of documents in files with Elias-Fano coded document boundaries.

A file holds the ids of its documents one after the other, as unsigned numbers of two or four bytes, and in
front of them two Elias-Fano sequences: where each document ends, and the doc_ids, ascending. Of a
sequence of n values up to u, the low bits of each value (about log2(u / n)) stand packed side by side and the high
parts are unary in a bit vector of some 2n bits, so a value costs about 2 + log2(u / n) bits. A sample of the
place of every ``SAMPLE``-th set bit makes ``select`` a short scan: the k-th boundary, or the place of
a doc_id by binary search, comes from a few words of the file, and no table of 64-bit offsets exists, in the file or in memory.

    magic, width of an id | documents, ids, documents without doc_id, smallest doc_id | two sequences | ids

Texts are dealt by ranges of doc_id (and of the hash of the text, so that one doc_id with many rows is dealt too) and
each task writes files of about ``FILE_BYTES``, or of ``FILE_DOCUMENTS`` shorter ones, in that order, under names of the attempt: a task holds the
ids and numbers of one file, and encodes up to ``TEXT_BYTES`` of text, or one longer text, at a time. The table of files is
written by Spark and names only files of attempts that ended well, its rows brought together first, as a row of each task would be a Parquet file; the place
of a file's first id in the whole corpus comes from the sizes in it. Files are read one by one, each in a task.

Tokenizing: where the tokenizer drops white space and looks at nothing across it (its normalizer and word pattern are
checked, and a probe text compared), each word between ASCII white space is encoded once and kept for the next
texts, words of Latin letters by the model of the tokenizer alone; every other tokenizer gets the whole text. All give the same ids.

Defined cases: a null or empty text, or one of white space only, is the end id alone; rows without doc_id come first;
repeated rows are documents of their own, rows of equal doc_id go by the hash of their text; control strings in a
text are ordinary text; an empty table gives no files and no rows; a document larger than a file gets a larger file of its own.
Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.storage import materialize, remember
from keyrill.session import work_dir
from keyrill.sinks.files import filesystem, qualified

END_ID = 1
FILE_BYTES = 32 << 20
FILE_DOCUMENTS = 1 << 18
SAMPLE = 256
KEPT_WORDS = 1 << 19
TEXTS_AT_ONCE = 256
TEXT_BYTES = 4 << 20
DOCUMENTS_AT_ONCE = 1 << 10
LONGEST_KEPT = 64

MAGIC = b"krtok\x00\x00\x01"
HEAD = "<8sIIQQQq"
SEQUENCE = "<QQIIII"

# A word pattern that matches no white space, and normalizers that do not look across it.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LOCAL_NORMALIZERS = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"})
LATIN_WORD = re.compile(r"(?m)^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)|([^\n]*))$")
PROBE = "It's 3 o'clock,  naïve\n\n \tÈre ñ 北京  x<|endoftext|> 😀 DON'T\x00!  ́a\x1cb\x85c é İΣΑΣ "

FILES = "file string, part int, number int, documents long, ids long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class EliasFano:
    """A non-decreasing sequence of unsigned numbers in about 2 + log2(u / n) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(ones[-1]) + 1 if n else 0) // 64) * 64, np.uint8)
        bits[ones] = 1
        low = np.zeros(0, np.uint8)
        if width:
            shifts = np.arange(width, dtype=np.uint64)
            # Some values at a time, whose low bits fill whole bytes: a bit takes eight bytes until it is packed.
            some = (values[at : at + DOCUMENTS_AT_ONCE, None] for at in range(0, n, DOCUMENTS_AT_ONCE))
            low = np.concatenate([np.packbits(((v >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") for v in some])
        return cls(n, width, low, np.packbits(bits, bitorder="little").view("<u8"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack(SEQUENCE, self.n, self.low_bits, len(self.low), len(self.high), len(self.samples), 0)
        return head + self.samples.tobytes() + self.high.tobytes() + self.low.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that begins at a byte, and where it ends."""
        n, low_bits, low, high, samples, _ = struct.unpack_from(SEQUENCE, data, at)
        at += struct.calcsize(SEQUENCE)
        parts = []
        for count, kind in ((samples, "<u4"), (high, "<u8"), (low, "u1")):
            parts.append(np.frombuffer(data, kind, count, at))
            at += count * np.dtype(kind).itemsize
        return cls(n, low_bits, parts[2], parts[1], parts[0]), at

    def select(self, k: np.ndarray) -> np.ndarray:
        """Places of the k-th set bits (from 0) of the high parts: from the sample before, word by word."""
        at = self.samples[k // SAMPLE].astype(np.int64)
        left = k % SAMPLE  # set bits still to pass, the sampled one not counted
        word = at >> 6
        held = self.high[word] & (~np.uint64(0) << (at & 63).astype(np.uint64))
        ones = np.bitwise_count(held).astype(np.int64)
        behind = np.flatnonzero(left >= ones)
        while len(behind):
            left[behind] -= ones[behind]
            word[behind] += 1
            held[behind] = self.high[word[behind]]
            ones[behind] = np.bitwise_count(held[behind])
            behind = behind[left[behind] >= ones[behind]]
        place = np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):  # binary search inside the word
            below = np.bitwise_count(held & np.uint64((1 << half) - 1)).astype(np.int64)
            up = left >= below
            left -= np.where(up, below, 0)
            place += np.where(up, half, 0)
            held = np.where(up, held >> np.uint64(half), held & np.uint64((1 << half) - 1))
        return (word << 6) + place

    def __getitem__(self, k) -> np.ndarray:
        """The values at the places ``k``."""
        k = np.atleast_1d(np.asarray(k, np.int64))
        high = (self.select(k) - k).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        bit = k[:, None] * self.low_bits + np.arange(self.low_bits)
        ones = (self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        return high | (ones.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def values(self, chunk: int = DOCUMENTS_AT_ONCE) -> Iterator[np.ndarray]:
        for at in range(0, self.n, chunk):
            yield self[np.arange(at, min(at + chunk, self.n))]


class WordEncoder:
    """Token ids of texts as little-endian numbers of ``width`` bytes, the end id not included."""

    def __init__(self, path: str, by_word: bool | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.kept: dict[bytes, bytes] = {}
        self.by_word = False
        self.symbols = {b: c for c, b in byte_symbols().items() if b != 10}  # line ends part the words
        self.code = [np.array([i], self.kind).tobytes() for i in range(self.tokenizer.get_vocab_size())]
        if by_word is None:
            with open(path, encoding="utf-8") as f:
                by_word = self._separable(json.load(f))
        if by_word:
            whole = self._plain([PROBE])[0]
            self.by_word = True
            self.by_word = self([PROBE])[0] == whole

    @staticmethod
    def _separable(file: dict) -> bool:
        normalizer, words = file.get("normalizer") or {}, file.get("pre_tokenizer") or {}
        split, *rest = words.get("pretokenizers") or [{}]
        return (
            file["model"].get("type") == "BPE" and not file["model"].get("dropout")
            and normalizer.get("type") == "Sequence" and all(n in LOCAL_NORMALIZERS for n in normalizer["normalizers"])
            and split.get("type") == "Split" and split.get("pattern") == {"Regex": WORD_PATTERN}
            and split.get("behavior") == "Removed" and split.get("invert") is True
            and all(r.get("type") == "ByteLevel" and not r.get("add_prefix_space") and not r.get("use_regex") for r in rest)
        )

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """The ids of words without white space, one by one; the empty one has none."""
        if not words:
            return []
        # Latin letters, which every normalizer here only lowers, are one piece of the word pattern; so are marks after them.
        parts = LATIN_WORD.findall(b"\n".join(words).decode())
        low = "\n".join([head for head, _, _ in parts]).lower()
        pieces = low.encode().decode("latin-1").translate(self.symbols).split("\n")
        tokenize, code = self.tokenizer.model.tokenize, self.code
        marks = {mark: b"".join([code[t.id] for t in tokenize(mark)]) if mark else b"" for mark in {m for _, m, _ in parts}}
        found = [
            b"".join([code[t.id] for t in tokenize(piece)]) + marks[mark] if piece else b""
            for piece, (_, mark, _) in zip(pieces, parts, strict=True)
        ]
        other = [i for i, (head, _, _) in enumerate(parts) if not head]
        for i, ids in zip(other, self._plain([parts[i][2] for i in other]), strict=True):
            found[i] = ids
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._plain(texts)
        kept = self.kept
        if len(kept) > KEPT_WORDS:
            kept.clear()
        # Splitting, telling words apart and laying out their ids run in Arrow; the dictionary meets each word once a call.
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_pylist()
        new = [*filterfalse(kept.__contains__, words)]
        kept.update(zip(new, self._words(new), strict=True))
        ids = pa.array([*map(kept.__getitem__, words)], pa.large_binary()).take(coded.indices)
        if new and max(map(len, new)) > LONGEST_KEPT:
            for word in new:
                if len(word) > LONGEST_KEPT:
                    del kept[word]
        if not len(ids):
            return [b""] * len(texts)
        _, places, data = ids.buffers()
        ends = np.frombuffer(places, np.int64, len(ids) + 1)[split.offsets.to_numpy()].tolist()
        data = memoryview(data) if data is not None else b""
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, kept on the tokenizers module between tasks."""
    import tokenizers

    known = vars(tokenizers).setdefault("_keyrill_word_encoders", {})
    if path not in known:
        known[path] = WordEncoder(path)
    return known[path]


def pack(doc_ids: Iterable[int | None], ends: np.ndarray, ids: list[bytes], kind: str) -> Iterator[bytes]:
    """The bytes of a file, part by part, for doc_ids in ascending order, those that are null first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    without = len(ends) - len(known)
    size = np.dtype(kind).itemsize
    yield struct.pack(HEAD, MAGIC, size, 0, len(ends), int(ends[-1]) if len(ends) else 0, without, base)
    yield EliasFano.of(ends).to_bytes()
    yield EliasFano.of(known.astype(np.uint64) - np.uint64(base & (1 << 64) - 1)).to_bytes()
    yield from ids


class TokenFile:
    """A file that is read by document: ``read(start, length)`` gives bytes of it."""

    def __init__(self, read):
        self.read = read
        magic, self.size, _, self.n, self.ids, self.without, self.base = struct.unpack(HEAD, read(0, struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        self.kind = f"<u{self.size}"
        self.ends, at = self._sequence(struct.calcsize(HEAD))
        self.doc_ids, self.first = self._sequence(at)

    def _sequence(self, at: int) -> tuple[EliasFano, int]:
        n, _, low, high, samples, _ = struct.unpack(SEQUENCE, self.read(at, struct.calcsize(SEQUENCE)))
        size = struct.calcsize(SEQUENCE) + low + 8 * high + 4 * samples
        return EliasFano.from_bytes(self.read(at, size))[0], at + size

    def doc_id(self, k: int) -> int | None:
        return None if k < self.without else self._signed(self.doc_ids[k - self.without])[0]

    def _signed(self, offsets: np.ndarray) -> list[int]:
        return (offsets + np.uint64(self.base & (1 << 64) - 1)).astype(np.int64).tolist()

    def place(self, k: int) -> tuple[int, int]:
        """Where document ``k`` begins and ends among the ids of the file."""
        found = self.ends[[k - 1, k] if k else [k]]
        return (int(found[0]) if k else 0), int(found[-1])

    def document(self, k: int) -> np.ndarray:
        begin, end = self.place(k)
        return np.frombuffer(self.read(self.first + self.size * begin, self.size * (end - begin)), self.kind)

    def find(self, doc_id: int) -> int | None:
        """The number of the first document with a doc_id, by binary search over the coded doc_ids."""
        low, high = 0, self.doc_ids.n
        while low < high:
            middle = (low + high) // 2
            if self._signed(self.doc_ids[middle])[0] < doc_id:
                low = middle + 1
            else:
                high = middle
        same = low < self.doc_ids.n and self._signed(self.doc_ids[low])[0] == doc_id
        return low + self.without if same else None

    def documents(self) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """All documents, some at a time: their doc_ids, and where they begin and end."""
        known = self.doc_ids.values()
        held: list[int | None] = [None] * self.without
        begin = 0
        for ends in self.ends.values():
            while len(held) < len(ends):
                held += self._signed(next(known))
            starts = np.concatenate([[begin], ends[:-1].astype(np.int64)])
            begin = int(ends[-1])
            yield held[: len(ends)], starts, ends.astype(np.int64)
            held = held[len(ends):]


def portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that are encoded at once, of bounded number and bytes; a longer text goes alone."""
    begin = held = 0
    for i, size in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if i - begin == TEXTS_AT_ONCE or i > begin and held + size > TEXT_BYTES:
            yield begin, i
            begin, held = i, 0
        held += size
    if len(texts):
        yield begin, len(texts)


def _write(folder: str, tokenizer: str, end_id: int, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.kind).tobytes()
        size = np.dtype(encode.kind).itemsize
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        stem = f"part-{part:06d}-{uuid.uuid4().hex}"
        doc_ids, ends, held, written = [], [], [], 0

        def close(number: int) -> pa.RecordBatch:
            name = f"{stem}-{number}.ids"
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                for data in pack(doc_ids, np.array(ends, np.uint64), held, encode.kind):
                    out.write(data)
            row = [[name], [part], [number], [len(ends)], [ends[-1]]]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], names=["file", "part", "number", "documents", "ids"])

        for batch in batches:
            for first, last in portions(batch.column(1)):
                some = batch.slice(first, last - first)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc_id, ids in zip(some.column(0).to_pylist(), encode(texts), strict=True):
                    if ends and (ends[-1] * size + len(ids) >= file_bytes or len(ends) == FILE_DOCUMENTS):
                        yield close(written)
                        doc_ids, ends, held, written = [], [], [], written + 1
                    doc_ids.append(doc_id)
                    held += (ids, end)
                    ends.append((ends[-1] if ends else 0) + len(ids) // size + 1)
        if ends:
            yield close(written)

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all documents under ``folder``; gives the table of files with the ids before each."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    dealt = slim.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    rows = dealt.mapInArrow(_write(qualified(spark, folder), tokenizer, end_id, file_bytes), FILES)
    made = materialize(rows.repartition("part"), "token-files")
    # A row per task is accumulated, then a row per file of a task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = made.groupBy("part").agg(F.sum("ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("inside", F.coalesce(F.sum("ids").over(within), F.lit(0))).join(parts, "part")
    return materialize(placed.select("file", "part", "number", "documents", "ids", (F.col("first") + F.col("inside")).alias("start")), "token-file-starts")


def _read(folder: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with files.open_input_file(f"{root}/{name}") as f:
                    held = TokenFile(lambda at, n: f.read_at(n, at))
                    for doc_ids, begins, ends in held.documents():
                        data = held.read(held.first + held.size * int(begins[0]), held.size * int(ends[-1] - begins[0]))
                        ids = np.frombuffer(data, held.kind).astype("<u4")
                        bounds = np.concatenate([begins, ends[-1:]]) - begins[0]
                        whole = memoryview(ids).cast("B")
                        crc = [zlib.crc32(whole[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                        arrays = [pa.array(doc_ids, pa.int64()), pa.array(begins + start), pa.array(ends - begins), pa.array(crc, pa.int64())]
                        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                        if with_ids:
                            arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view(np.int32))))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def read(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """A row per document of the files in a table of ``write``, each file in one task."""
    spark = files.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = files.select("file", "start").repartition(tasks, "file")
    return dealt.mapInArrow(_read(qualified(spark, folder), with_ids), DOCUMENT + ", ids array<int>" * with_ids)


def token_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents into files in the shared folder and read every one back."""
    spark = docs.sparkSession
    folder = work_dir(spark, "token-ids")
    remember(spark, folder)
    return read(write(docs, folder, tokenizer), folder)
