"""Token ids as Arrow files of equal-length sequences with masks.

Documents are range-partitioned and sorted by key, so that file after file
holds the token stream in key order. A file is an Arrow IPC file whose record
batches have two fixed-size-list columns: ``ids`` (``SEQUENCE`` ids each) and
``mask`` (a byte each, 0 only on the padding that ends the file's last
sequence). The k-th sequence and its mask are thus slices of memory-mapped
buffers: random access without copying. A second small file per part lists its documents
(key, first id, number of ids).

Files are written under the session's shared folder with a temporary name and
moved into place, so a task that runs again replaces its own file. Sequences
do not cross files; the offset of a file in the stream is the sum of the
counts before it (a list with one entry a file on the driver).

Defined cases: a null text has only the end id; equal keys are ordered by the
hash of their text, then the text; null keys come first; an empty table gives no files and no rows; columns
besides key and text are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from scriptmill.llm.batches import slices
from scriptmill.runtime import Workspace, qualified, ship

SEQUENCE, BATCH = 1024, 256  # ids a sequence, sequences a record batch
MEMO = 500_000
#: The steps of a tokenizer whose pre-tokens of ASCII words are matches of ASCII (fixed values).
STEPS = (["NFC", "Replace", "Lowercase"], "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
PRINTABLE = re.compile(rb"[!-@\[-~]+")
#: Stands between words that are encoded together.
MARK = "\x01"


class ChunkEncoder:
    """Encodes whole texts with the tokenizers library, each distinct run of non-space characters once.

    Valid for tokenizers that lower-case and whose normaliser and pre-tokeniser
    treat ASCII white space only as a separator, so that no token spans it and
    no rule looks across it; the tests compare with encoding whole texts. A
    text that holds the string of an added token (in either case) is encoded
    whole, because such strings are found before anything else.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.added = [x.content.lower().encode() for x in self.t.get_added_tokens_decoder().values()]
        self.start = os.path.commonprefix(self.added)
        self.width = np.dtype("<u2") if self.t.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        mark = self.t.encode(MARK, add_special_tokens=False).ids
        if len(mark) != 1:
            raise ValueError("the tokenizer splits the mark")
        self.mark = mark[0]
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.direct = _splits_ascii(path)

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        raw = [x.encode() for x in texts]
        lower = [x.lower() for x in raw]
        whole = {i for i, x in enumerate(lower) if self.start in x and any(a in x for a in self.added)}
        folded = [r if _composes(r) else x for r, x in zip(raw, lower, strict=True)]
        words = [[] if i in whole else x.split() for i, x in enumerate(folded)]
        memo, tail = self.memo, np.array([end], self.width).tobytes()
        missing = []
        for w in set().union(*words).difference(memo) if words else ():
            if w in self.old:
                memo[w] = self.old[w]
            else:
                missing.append(w)
        if self.direct:
            missing = [w for w in missing if not self._ascii(w)]
        for i in range(0, len(missing), 512):
            memo.update(self._fresh(missing[i : i + 512]))
        out = [(self._library(texts[i]) if i in whole else b"".join(map(memo.__getitem__, w))) + tail for i, w in enumerate(words)]
        if len(memo) > MEMO:
            self.old, self.memo = {k: v for k, v in memo.items() if len(k) <= 64}, {}
        return out

    def _ascii(self, word: bytes) -> bool:
        """Remember a lower-case word of printable ASCII from its pre-tokens, each of which the library's model encodes once; False for any other word."""
        memo = self.memo
        if word.isalpha() and word.islower():  # bytes: ASCII letters only, one pre-token
            pieces = [word]
        elif PRINTABLE.fullmatch(word):
            pieces = ASCII.findall(word)
        else:
            return False
        for x in pieces:
            if x not in memo:
                memo[x] = np.array([t.id for t in self.t.model.tokenize(x.decode())], self.width).tobytes()
        if len(pieces) > 1:
            memo[word] = b"".join(map(memo.__getitem__, pieces))
        return True

    def _library(self, text: str) -> bytes:
        return np.array(self.t.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def _fresh(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words from one call: a mark between them, a token of its own, tells them apart."""
        plain = [w for w in words if MARK.encode() not in w]
        found = {w: self._library(w.decode()) for w in words if MARK.encode() in w}
        if plain:
            ids = np.array(self.t.encode_batch_fast([f" {MARK} ".join([w.decode() for w in plain])], add_special_tokens=False)[0].ids, self.width)
            cut = np.flatnonzero(ids == self.mark) * ids.itemsize
            if len(cut) != len(plain) - 1:
                raise ValueError("the tokenizer does not keep words apart")
            raw, step = ids.tobytes(), ids.itemsize
            found |= {w: raw[a:b] for w, a, b in zip(plain, [0, *(cut + step).tolist()], [*cut.tolist(), len(raw)], strict=True)}
        return found


def _composes(raw: bytes) -> bool:
    """Whether a combining mark (U+0300 to U+037F) might compose with a letter before letters are lower-cased; in all other texts ASCII letters can be lower-cased first, so that fewer distinct words remain."""
    return b"\xcc" in raw or b"\xcd" in raw


def _splits_ascii(path: str) -> bool:
    """Whether the tokenizer's file says that it lower-cases, splits by the pattern of STEPS, maps bytes one by one and does nothing else."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    steps = [x.get("type") for x in (d.get("normalizer") or {}).get("normalizers", [])]
    split, *rest = (d.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    byte_level = [(x.get("type"), x.get("add_prefix_space"), x.get("use_regex")) for x in rest] == [("ByteLevel", False, False)]
    same = (steps, (split.get("pattern") or {}).get("Regex")) == STEPS and split.get("behavior") == "Removed" and split.get("invert") is True
    return same and byte_level and not d.get("post_processor") and (d.get("model") or {}).get("type") == "BPE"


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


class _Stream:
    """Cuts ids into sequences and writes them batch by batch."""

    def __init__(self, fs, path: str, width):
        item = pa.from_numpy_dtype(width)
        self.schema = pa.schema([("ids", pa.list_(item, SEQUENCE)), ("mask", pa.list_(pa.uint8(), SEQUENCE))])
        self.out = fs.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.width, self.held, self.size = width, [], 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= SEQUENCE * BATCH:
            self.cut(self.size // SEQUENCE * SEQUENCE)

    def cut(self, n: int) -> None:
        """Write the first n ids held; beyond those held, padding."""
        ids = np.concatenate([*self.held, np.zeros(max(0, n - self.size), self.width)])
        mask = (np.arange(n) < self.size).view(np.uint8)
        for i in range(0, n, SEQUENCE * BATCH):
            part = slice(i, min(n, i + SEQUENCE * BATCH))
            self.writer.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids[part]), SEQUENCE), pa.FixedSizeListArray.from_arrays(pa.array(mask[part]), SEQUENCE)], schema=self.schema))
        self.held, self.size = [ids[n:].copy()] if n < self.size else [], max(0, self.size - n)

    def close(self) -> None:
        if self.size:
            self.cut(-(-self.size // SEQUENCE) * SEQUENCE)
        self.writer.close()
        self.out.close()


def write_sequences(df: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> list:
    """Write the files of a table under ``folder`` (a URI that all executors reach); returns one row (part, n_docs, n_ids) a file, in stream order."""
    ship(df.sparkSession)
    key_type = to_arrow_type(df.schema[key].dataType)
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1])

    def run(batches):
        enc, part, stream, keys, counts = _encoder(tokenizer), TaskContext.get().partitionId(), None, [], []
        fs, base = pafs.FileSystem.from_uri(folder)
        draft = f"{base}/_{uuid.uuid4().hex}"
        for b in batches:
            for s in slices(b, 1, 1024, 4 << 20):
                if stream is None:
                    stream = _Stream(fs, f"{draft}.arrow", enc.width)
                ids = enc.encode([x or "" for x in s.column(1).to_pylist()], end_id)
                counts += [len(x) // enc.width.itemsize for x in ids]
                stream.add(np.frombuffer(b"".join(ids), enc.width))
                keys.append(s.column(0))
        if stream is None:
            return
        stream.close()
        n = np.array(counts, np.int64)
        index = pa.table({"key": pa.chunked_array(keys, key_type), "first": np.cumsum(n) - n, "n": n})
        with fs.open_output_stream(f"{draft}.docs") as out, pa.ipc.new_file(out, index.schema) as w:
            w.write_table(index)
        for kind in ("arrow", "docs"):
            fs.move(f"{draft}.{kind}", f"{base}/part-{part:06d}.{kind}")
        yield pa.record_batch({"part": pa.array([part], pa.int64()), "n_docs": pa.array([len(n)], pa.int64()), "n_ids": pa.array([int(n.sum())], pa.int64())})

    rows = df.select(key, text, F.xxhash64(text).alias("_tie")).repartitionByRange(key, "_tie").sortWithinPartitions(key, "_tie", text).select(key, text)
    return sorted(rows.mapInArrow(run, "part long, n_docs long, n_ids long").collect(), key=lambda r: r.part)


class SequenceFile:
    """Random access to one file; on a local file system the arrays are views of the mapped file."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.batches = [self.reader.get_batch(i) for i in range(self.reader.num_record_batches)]
        self.starts = np.cumsum([0] + [b.num_rows for b in self.batches])
        self.flat = [b.column(0).flatten().to_numpy() for b in self.batches]  # views

    def __len__(self) -> int:
        return int(self.starts[-1])

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of the k-th sequence, both views."""
        at = int(np.searchsorted(self.starts, k, "right")) - 1
        b, i = self.batches[at], k - int(self.starts[at])
        return tuple(b.column(c).flatten().slice(i * SEQUENCE, SEQUENCE).to_numpy() for c in (0, 1))

    def ids(self, first: int, n: int) -> np.ndarray:
        """n ids of the file's stream from ``first`` on."""
        out = []
        while n > 0:
            at = int(np.searchsorted(self.starts * SEQUENCE, first, "right")) - 1
            if at >= len(self.batches):
                break
            i = first - int(self.starts[at]) * SEQUENCE
            out.append(self.flat[at][i : i + n])
            first, n = first + len(out[-1]), n - len(out[-1])
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint32)


def read_documents(spark, folder: str, files: list, key: StructField) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files: one task a file."""
    ship(spark)
    base, rows = 0, []
    for r in files:
        rows.append((r.part, base))
        base += r.n_ids
    schema = StructType([key, *StructType.fromDDL("start long, n_tokens long, ids_crc32 long").fields])
    if not rows:
        return spark.createDataFrame([], schema)
    key_type = to_arrow_type(key.dataType)

    def run(batches):
        for b in batches:
            for part, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                name = f"{folder}/part-{part:06d}"
                f = SequenceFile(f"{name}.arrow")
                fs, path = pafs.FileSystem.from_uri(f"{name}.docs")
                with fs.open_input_file(path) as src:
                    docs = pa.ipc.open_file(src).read_all()
                first, n = docs["first"].to_numpy(), docs["n"].to_numpy()
                crc = [zlib.crc32(f.ids(int(i), int(c)).astype("<u4").tobytes()) for i, c in zip(first, n, strict=True)]
                yield pa.RecordBatch.from_arrays([docs["key"].combine_chunks().cast(key_type), pa.array(first + at), pa.array(n), pa.array(crc, pa.int64())], names=schema.fieldNames())

    parts = spark.sparkContext.parallelize(rows, len(rows))
    return spark.createDataFrame(parts, StructType([StructField("part", LongType()), StructField("at", LongType())])).mapInArrow(run, schema)


def round_trip(df: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files into the session's shared folder and read every document back."""
    ws = Workspace(df.sparkSession, "sequences")
    folder = qualified(df.sparkSession, ws.path("files"))
    return read_documents(df.sparkSession, folder, write_sequences(df, folder, tokenizer, end_id, key, text), df.schema[key])
