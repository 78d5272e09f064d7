"""Token ids in binary files: one id array per file, document boundaries in Elias-Fano code.

A file is: magic, version, bytes per id, number of documents, number of ids, number of documents
without an id; the ids; the boundaries (all ends, as an Elias-Fano sequence); the document ids, an
Elias-Fano sequence over their distance to the smallest. Files are cut by ranges of the document
id, so the files in order hold the corpus in ascending document order.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.llm.common import filesystem, parts, saved, shared_folder, texts_of
from gleanwell.llm.elias_fano import EliasFano, encode

MAGIC = b"TOKENS01"
HEAD = "<8sB7xQQQq"  # magic, id bytes, documents, ids, documents with no id, smallest id
FILE_TEXT = 64 << 20  # bytes of text a file is cut for
CACHE = 300_000  # words, and pieces of words, of one generation that a worker keeps the ids of
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")  # words whose letters all are Latin-1 and composed
LETTERS, DIGITS = "a-zß-öø-ÿ", "0-9"  # what \p{L} and \p{N} are in such a word, in lower case


class Remembered(dict):
    """Values by key, each computed once while it is in use: two generations, the older one goes."""

    def __init__(self, compute: Callable):
        self.compute, self.old = compute, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte: itself if it is visible, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + i for i, b in enumerate(hidden)}


class WordIds:
    """The little-endian ids of single words, for tokenizers that drop white space.

    Such a tokenizer cuts a text at white space first and never looks across it, so the ids of a
    text are those of its words in order. Words recur, and so do the pieces that the tokenizer's
    pattern cuts them into, which go to its model one by one. Words with other than Latin-1
    letters, or with what may be a special token, are encoded as a whole.
    """

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), f"<u{width}"
        pattern = first_split(path)["pattern"]["Regex"]
        self.cut = re.compile(pattern.replace("\\p{L}", LETTERS).replace("\\p{N}", DIGITS))
        self.letters = byte_letters()
        self.pieces = Remembered(self.piece)
        self.words = Remembered(self.word)

    def piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.tokenizer.model.tokenize(letters)], self.kind).tobytes()

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if "<|" in text or not PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return b"".join(map(self.pieces.__getitem__, self.cut.findall(text.lower())))


_WORDS: dict[tuple[str, int], WordIds] = {}  # of this worker process, for all its tasks


def word_encoder(path: str, end_id: int, width: int) -> Callable[[list[bytes]], list[bytes]]:
    """Encodes texts word by word; see ``WordIds``."""
    known = _WORDS.setdefault((path, width), None) or WordIds(path, width)
    _WORDS[path, width] = known
    get, end = known.words.__getitem__, np.array([end_id], known.kind).tobytes()
    return lambda texts: [b"".join(map(get, t.split())) + end for t in texts]


def text_encoder(path: str, end_id: int, width: int) -> Callable[[list[bytes]], list[bytes]]:
    """Encodes whole texts, for any tokenizer."""
    from tokenizers import Tokenizer

    tokenizer, kind = Tokenizer.from_file(path), f"<u{width}"
    end = np.array([end_id], kind).tobytes()

    def run(texts: list[bytes]) -> list[bytes]:
        coded = tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(c.ids, kind).tobytes() + end for c in coded]

    return run


def first_split(path: str) -> dict:
    """The first pre-tokenizer of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        step = json.load(file).get("pre_tokenizer") or {}
    return step.get("pretokenizers", [step])[0]


def splits_at_spaces(path: str) -> bool:
    """True if the file drops white space, looks at lower-cased single words only and is a BPE
    over bytes, which is what ``WordIds`` needs."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    first, pattern = first_split(path), first_split(path).get("pattern", {}).get("Regex", " ")
    steps = [s["type"] for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    special = all(
        t["content"].startswith("<|") and " " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])
        for t in spec["added_tokens"]
    )
    return (
        bool(first.get("invert")) and first.get("behavior") == "Removed" and " " not in pattern
        and pattern.endswith("[^\\s\\p{L}\\p{N}]+") and steps == ["Split", "ByteLevel"]
        and normal == ["NFC", "Replace", "Lowercase"] and spec["model"]["type"] == "BPE" and special
    )


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    folder: str | None = None, files: int | None = None, width: int = 2,
) -> DataFrame:
    """Encode every text, write the files and return their list: path, first_id, documents, ids.

    Every document ends with ``end_id``. Null texts are empty. Documents without an id come first;
    rows of equal id follow each other by text. Empty tables write no file. The list is itself saved, and
    only files on it count: a task that runs twice leaves a second file that nothing reads.
    ``width`` is the bytes per id. ``files`` defaults to one per 64 MB of text.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    make = word_encoder if splits_at_spaces(tokenizer) else text_encoder
    slim = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    if files is None:
        size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(spark.sparkContext.defaultParallelism, -(-size // FILE_TEXT))
    ordered = (
        slim.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(files, F.col("id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie", "text")
        .select("id", "text")
    )

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = make(tokenizer, end_id, width)
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        path = f"{base}/{uuid.uuid4().hex}.tokens"
        ids, sizes = [], []
        with store.open_output_stream(path + ".ids") as out:
            for batch in parts(batches):
                ids += batch.column("id").to_pylist()
                for coded in code(texts_of(batch, "text")):
                    out.write(coded)
                    sizes.append(len(coded) // width)
        if not ids:
            store.delete_file(path + ".ids")
            return
        none = ids.index(next((i for i in ids if i is not None), None)) if ids[-1] is not None else len(ids)
        known = np.array(ids[none:], dtype=np.int64)
        least = int(known[0]) if len(known) else 0
        ends = np.cumsum(np.array(sizes, dtype=np.int64))
        total = int(ends[-1])
        with store.open_output_stream(path) as out, store.open_input_stream(path + ".ids") as body:
            out.write(struct.pack(HEAD, MAGIC, width, len(ids), total, none, least))
            while piece := body.read(1 << 22):
                out.write(piece)
            out.write(encode(ends))
            out.write(encode((known - least).astype(np.uint64)))
        store.delete_file(path + ".ids")
        first = ids[0] if ids[0] is not None else None
        yield pa.RecordBatch.from_pydict({
            "path": [f"{folder}/{path.rpartition('/')[2]}"], "first_id": pa.array([first], pa.int64()),
            "documents": [len(ids)], "ids": [total], "bytes": [store.get_file_info(path).size],
        })

    part = "path string, first_id long, documents long, ids long, bytes long"
    written = ordered.mapInArrow(shard, part).withColumn("part", F.spark_partition_id())
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = saved(written, "token-list")
    return listed.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class TokenFile:
    """One file: the ids as an array, and the bounds of a document by select."""

    def __init__(self, data: bytes):
        magic, self.width, self.documents, self.total, self.none, self.least = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.ids = np.frombuffer(data, f"<u{self.width}", self.total, struct.calcsize(HEAD))
        at = struct.calcsize(HEAD) + self.total * self.width
        self.ends = EliasFano(data[at:])
        self.known = EliasFano(data[at + self.ends.bytes :])

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.none + [int(v) + self.least for v in self.known.values()]


def read_tokens(listed: DataFrame, arrays: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and, if asked, ids."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = filesystem(row["path"])
                with store.open_input_stream(path) as file:
                    found = TokenFile(file.read())
                ends = found.ends.values().astype(np.int64)
                names = found.doc_ids()
                for at in range(0, len(names), 4096):
                    upto = ends[at : at + 4096]
                    origin = int(ends[at - 1]) if at else 0
                    wide = memoryview(found.ids[origin : int(upto[-1])].astype("<u4")).cast("B")
                    marks = [0, *(upto - origin).tolist()]
                    data = {
                        "doc_id": pa.array(names[at : at + 4096], pa.int64()),
                        "start": [row["start"] + origin + m for m in marks[:-1]],
                        "n_tokens": [b - a for a, b in zip(marks, marks[1:])],
                        "ids_crc32": [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(marks, marks[1:])],
                    }
                    if arrays:
                        cut = [found.ids[origin + a : origin + b] for a, b in zip(marks, marks[1:])]
                        data["ids"] = pa.array([c.tolist() for c in cut], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(data)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    jobs = listed.select("path", "start").repartition(F.col("path"))
    return jobs.mapInArrow(unpack, schema + (", ids array<int>" if arrays else ""))
