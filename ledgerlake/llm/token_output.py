"""Token ids as Arrow files: fixed-size-list batches of equal-length sequences and masks.

Documents are range-partitioned by doc_id (and the begin of the text, which parts rows of one
doc_id) and encoded where they land. Each partition writes
one Arrow IPC file whose rows are sequences of ``SEQ_LEN`` ids (``FixedSizeList<uint16>``, wider
only for larger vocabularies) with a bit mask of the same shape (false: padding after the last
id), and a second small Arrow file with the place of each document in it. Lists of fixed size
are one flat buffer, so a reader maps the file and slices any sequence or document without a
copy. ``start`` of a document counts the ids of all documents before it in the whole corpus.

Encoding: the tokenizer drops white space and never joins a letter or digit with the
punctuation beside it (contractions aside), so texts are cut into pieces, many texts at a time,
and every distinct piece is encoded only once per worker, as long as it is kept. Texts for which that is not certain
(not in NFC, rare white space, special tokens, unassigned characters, letters whose lower case
depends on their place) are encoded whole, and so are pieces with numerals that are no decimal
digits.

Defined cases: a null text counts as empty (only the end id); null doc_ids come first; rows with
the same doc_id are ordered by text; empty tables write no file; other columns are not read.
Retried tasks write the same bytes under the same name, by rename from a name of their own.
"""

from __future__ import annotations

import os
import posixpath
import sys
import types
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, bounded_batches, columns, documents

SEQ_LEN = 2048
END_ID = 1
#: Distinct pieces in one generation of those that a worker keeps encoded; it keeps two.
CACHE_PIECES = 250_000
_BATCH_SEQS = 512
#: Bytes of text cut into pieces at a time (a longer text is cut by itself).
GROUP_BYTES = 1 << 20
_SPACE, _LETTER, _MARK, _OTHER, _APOSTROPHE = range(5)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[list(b" \t\n\r\x0b\x0c")] = _SPACE
_KIND[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
_KIND[0x80:] = _OTHER
_KIND[0x27] = _APOSTROPHE
#: Whether a piece begins between two kinds of bytes (5 * one before + this one). Characters
#: outside ASCII that may be letters or marks stay with what stands beside them.
_BEGINS = np.zeros(25, bool)
_BEGINS[[5 * _SPACE + k for k in (_LETTER, _MARK, _OTHER, _APOSTROPHE)]] = True
_BEGINS[[5 * _LETTER + _MARK, 5 * _LETTER + _APOSTROPHE, 5 * _MARK + _LETTER]] = True
_BLANKS = frozenset(" \t\n\r\x0b\x0c")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Store:
    """Encoded pieces, two generations of them: a full one takes the place of the older, and
    what is found in the older moves to the newer, so frequent pieces stay."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, piece: str) -> bytes | None:
        ids = self.new.get(piece)
        if ids is None:
            ids = self.old.get(piece)
            if ids is not None:
                self.put(piece, ids)
        return ids

    def put(self, piece: str, ids: bytes) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[piece] = ids


class PieceEncoder:
    """Ids of whole texts, with a bounded store of the pieces encoded so far."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = _Store(cache_pieces)
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        self.byte_chars = {b: chr(b) for b in printable} | \
            {b: chr(256 + k) for k, b in enumerate(others)}

    def _piece(self, piece: bytes) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            text = piece.decode()
            if text.isalpha():  # one word of the vocabulary's model; other numerals are not
                mapped = text if text.isascii() else \
                    piece.decode("latin-1").translate(self.byte_chars)
                found = [t.id for t in self.tokenizer.model.tokenize(mapped)]
            else:
                found = self.tokenizer.encode(text, add_special_tokens=False).ids
            ids = array("I", found).tobytes()
            self.pieces.put(piece, ids)
        return ids

    def _by_pieces(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of lower-cased texts: every distinct piece of all of them is looked up once."""
        data = np.frombuffer(b"\n".join([b"", *texts]), np.uint8)
        kind = _KIND[data]
        lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))  # U+00C0 to U+017F
        lead = lead[(data[lead] > 0xC3) | (data[lead + 1] & 0xDF != 0x97)]  # no letters: × and ÷
        kind[lead] = kind[lead + 1] = _LETTER
        starts = np.flatnonzero(_BEGINS[kind[:-1] * np.uint8(5) + kind[1:]]) + 1
        offsets = np.append(starts, len(data))
        # a piece runs up to the next one; white space behind it is no part of it
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]) \
            .dictionary_encode()
        _, bounds, flat = pieces.dictionary.buffers()
        bounds = np.frombuffer(bounds, np.int64)[:len(pieces.dictionary) + 1].tolist()
        flat = flat.to_pybytes() if flat else b""
        known, make = self.pieces.new.get, self._piece
        found = [known(p) or make(p)
                 for p in [flat[a:z].rstrip() for a, z in zip(bounds, bounds[1:])]]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = pieces.indices
        ids = pa.LargeListArray.from_arrays(
            np.concatenate([[0], sizes.cumsum()]), np.frombuffer(b"".join(found), np.uint32)) \
            .take(which).flatten().to_numpy()
        before = np.concatenate([[0], sizes[which.to_numpy()].cumsum()])
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = before[np.searchsorted(starts, np.concatenate([[0], ends]))]
        return [ids[a:z] for a, z in zip(cuts[:-1], cuts[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        held, size = {}, 0
        for k, text in enumerate(texts):
            if _whole(text):
                out[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids,
                                  np.uint32)
                continue
            held[k] = text.lower().encode()
            size += len(held[k])
            if size >= GROUP_BYTES:
                for i, ids in zip(held, self._by_pieces(list(held.values()))):
                    out[i] = ids
                held, size = {}, 0
        for i, ids in zip(held, self._by_pieces(list(held.values()))):
            out[i] = ids
        return out

    def __call__(self, text: str) -> np.ndarray:
        return self.encode([text])[0]


def _whole(text: str) -> bool:
    """Whether it is not certain that a text may be cut into pieces."""
    if "<|" in text:
        return True
    if text.isascii():
        return any(c in text for c in "\x1c\x1d\x1e\x1f")
    # a character unassigned here may be known to the tokenizer's newer Unicode
    return any(c in "Σİ" or c.isspace() or unicodedata.category(c) == "Cn"
               for c in set(text) - _BLANKS) or not unicodedata.is_normalized("NFC", text)


def worker_encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker, kept from task to task with its stored pieces."""
    kept = sys.modules.setdefault("_ledgerlake_worker", types.ModuleType("_ledgerlake_worker"))
    if path not in kept.__dict__:
        setattr(kept, path, PieceEncoder(path))
    return getattr(kept, path)


def _file_system(url: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(url)


class _File:
    """An Arrow IPC file, written under a task's own name and renamed when whole."""

    def __init__(self, url: str, schema: pa.Schema, attempt: int):
        self.fs, self.path = _file_system(url)
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.own = f"{self.path}.{attempt}"
        self.sink = self.fs.open_output_stream(self.own)
        self.writer = pa.ipc.new_file(self.sink, schema)

    def close(self) -> None:
        self.writer.close()
        self.sink.close()
        self.fs.move(self.own, self.path)


def sequence_schema(seq_len: int, dtype: np.dtype) -> pa.Schema:
    return pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)),
                      ("mask", pa.list_(pa.bool_(), seq_len))])


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_FILES = pa.schema([("url", pa.string()), ("base", pa.int64()), ("n_docs", pa.int64()),
                    ("n_ids", pa.int64())])


def write_sequences(url: str, docs: Iterator[tuple[list, list[np.ndarray]]], seq_len: int,
                    dtype: np.dtype, attempt: int) -> tuple[int, int]:
    """Write one file of sequences and its index; the numbers of documents and ids."""
    schema = sequence_schema(seq_len, dtype)
    out, index = _File(url, schema, attempt), _File(url + ".docs", _INDEX, attempt)
    pending: list[np.ndarray] = []
    held = n_docs = n_ids = 0

    def flush(ids: np.ndarray) -> None:
        mask = np.arange(-(-len(ids) // seq_len) * seq_len) < len(ids)
        padded = np.zeros(len(mask), dtype)
        padded[:len(ids)] = ids
        for a in range(0, len(mask), _BATCH_SEQS * seq_len):
            part = slice(a, a + _BATCH_SEQS * seq_len)
            out.writer.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(x[part]), seq_len)
                 for x in (padded, mask)], schema=schema))

    for doc_ids, ids in docs:
        sizes = np.array([len(x) for x in ids], np.int64)
        index.writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(n_ids + np.cumsum(sizes) - sizes),
             pa.array(sizes)], schema=_INDEX))
        pending += [x.astype(dtype) for x in ids]
        n_docs, n_ids, held = n_docs + len(ids), n_ids + int(sizes.sum()), held + int(sizes.sum())
        if held >= _BATCH_SEQS * seq_len:
            flat = np.concatenate(pending)
            full = len(flat) // seq_len * seq_len
            flush(flat[:full])
            pending, held = [flat[full:]], len(flat) - full
    if held:
        flush(np.concatenate(pending))
    out.close()
    index.close()
    return n_docs, n_ids


def open_sequences(url: str):
    """The reader of one file; local files are mapped, so batches are views of the file."""
    fs, path = _file_system(url)
    source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) \
        else fs.open_input_file(path)
    return pa.ipc.open_file(source)


def sequence(reader, i: int) -> tuple[np.ndarray, pa.Array]:
    """Sequence i of a file: its ids as a view, and its mask."""
    batch, row = divmod(i, _BATCH_SEQS)
    ids, mask = (reader.get_batch(batch).column(k) for k in range(2))
    n = ids.type.list_size
    at = (ids.offset + row) * n
    return ids.values.to_numpy(zero_copy_only=True)[at:at + n], mask[row].values


def read_documents(url: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches of the index of a file, with the ids of each of their documents."""
    reader, index = open_sequences(url), open_sequences(url + ".docs")
    ids, first, batch = np.zeros(0, np.uint16), 0, 0
    for k in range(index.num_record_batches):
        docs = index.get_batch(k)
        start, size = (docs.column(j).to_numpy() for j in (1, 2))
        parts = [ids]
        have = first + len(ids)
        while len(start) and have < start[-1] + size[-1]:
            parts.append(reader.get_batch(batch).column(0).values.to_numpy(zero_copy_only=True))
            have, batch = have + len(parts[-1]), batch + 1
        ids = np.concatenate(parts) if len(parts) > 1 else ids
        yield docs, [ids[a - first:a - first + n] for a, n in zip(start, size)]
        if len(start):
            done = int(start[-1] + size[-1])
            ids, first = ids[done - first:], done


def grouped(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows of consecutive batches together, until they hold ``size`` bytes; never none."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.nbytes
            if n >= size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def write_corpus(docs: DataFrame, root: str, tokenizer: Callable[[], str] | str,
                 seq_len: int = SEQ_LEN, end_id: int = END_ID) -> DataFrame:
    """Encode and write ``docs`` under ``root``; one row per file: url, base, n_docs, n_ids."""
    spark = docs.sparkSession
    path = tokenizer if isinstance(tokenizer, str) else tokenizer()

    def encode(batches):
        encoder = worker_encoder(path)
        top = max(end_id, encoder.tokenizer.get_vocab_size(with_added_tokens=True) - 1)
        dtype = np.dtype(np.uint16 if top < 1 << 16 else np.uint32)
        end = np.array([end_id], np.uint32)
        context = TaskContext.get()

        def encoded():
            for b in grouped(batches, GROUP_BYTES):
                texts = [t or "" for t in b.column(1).to_pylist()]
                yield b.column(0).to_pylist(), [np.concatenate([ids, end])
                                                for ids in encoder.encode(texts)]
        found = encoded()
        first = next(found, None)
        if first is None:
            return
        url = f"{root}/part-{context.partitionId():06d}.arrow"

        def all_docs():
            yield first
            yield from found
        n_docs, n_ids = write_sequences(url, all_docs(), seq_len, dtype, context.taskAttemptId())
        pa.default_memory_pool().release_unused()  # the worker stays, for other tasks too
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (context.partitionId(), url, n_docs, n_ids)],
            ["part", "url", "n_docs", "n_ids"])

    bounded_batches(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)  # without a scheme: the default system's
    root = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder) \
        .toUri().toString().replace("file:/", "file:///", 1)
    files = columns(docs, "doc_id", "text") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .repartitionByRange("doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text") \
        .mapInArrow(encode, "part bigint, url string, n_docs bigint, n_ids bigint") \
        .collect()  # one row per file
    base, rows = 0, []
    for f in sorted(files):
        rows.append((f.url, base, f.n_docs, f.n_ids))
        base += f.n_ids
    # as Arrow: a list would be read by Python workers of another kind, kept beside these
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(_FILES.types)],
        schema=_FILES))


def read_corpus(files: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    def read(batches):
        for b in batches:
            for url, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for docs, ids in read_documents(url):
                    crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column(0), pa.array(docs.column(1).to_numpy() + base),
                         docs.column(2), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
    tasks = max(1, files.count())
    return files.select("url", "base").repartition(tasks) \
        .mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_output(docs: DataFrame, tokenizer: Callable[[], str] | str = default_tokenizer
                 ) -> DataFrame:
    """Write all documents as token files in the shared folder and read them back."""
    root = Scratch(docs.sparkSession, "tokens").path("sequences")
    return read_corpus(write_corpus(docs, root, tokenizer))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(documents(spark, sf_dir))
