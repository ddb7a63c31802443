"""Token-ID output: documents in ascending doc_id order, tokenized, in wavelet-matrix shards (see wavelet.py).

Documents are range-partitioned by doc_id; each task tokenizes its rows in order and writes a file for every
SHARD_TOKENS ids, so its memory is bounded however large its partition is. Files go to the shared folder under names
of their own; only the names that a successful task returns are in the manifest, so lost executors and repeated tasks
do no harm. Reading maps over the manifest, one file at a time.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import new_path, text_buffers, written
from plumbline.llm.wavelet import dump, load

SHARD_TOKENS = 1 << 22
END_ID = 2
#: Words whose ids a Python worker remembers before it starts anew with a slice. Only speed depends on it.
CACHE_WORDS = 600_000
#: Bytes of text that are split into words at once, unless one text has more.
SLICE = 1 << 23
#: Words given to the tokenizer in one text.
TOGETHER = 200
MARKS = ".,!?;:"


#: A-Z lower-cased, ASCII white space as a space.
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_LOW[9:14] = 32


_LETTER, _MARK = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (bytes(range(97, 123)), MARKS.encode()))


def spaced(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts' bytes and offsets with a space between each letter a-z and a mark after it, which are words of their own to the
    tokenizer anyway: fewer distinct words are left."""
    at = np.flatnonzero(_LETTER[raw[:-1]] & _MARK[raw[1:]]) + 1
    return np.insert(raw, at, 32), off + np.searchsorted(at, off)


def gather(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """pool[first[0] : first[0] + size[0]], pool[first[1] : ...] and so on, one after the other."""
    ends = np.cumsum(size)
    at = np.repeat(first - (ends - size), size)
    at += np.arange(len(at), dtype=at.dtype)
    return pool.take(at)


class Words:
    """Distinct words, A-Z lower-cased: place[word] is i, and the word's ids are pool[first[i] : first[i] + size[i]]."""

    def __init__(self, tokenizer, dtype):
        self.tokenizer, self.dtype = tokenizer, dtype
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        self.ends[[i for x, i in tokenizer.get_vocab().items() if x.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {"": 0}
        self.first, self.size, self.pool = np.zeros(1, np.int64), np.zeros(1, np.int64), np.empty(0, self.dtype)

    def places(self, words: list[str]) -> np.ndarray:
        """The place of each word, which is learned first if it is new."""
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            self.learn(new)
            at[missing] = np.fromiter(map(self.place.__getitem__, new), np.int64, len(new))
        return at

    def add(self, words: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        """Words whose ids are those of `ids`, one after the other."""
        size = np.concatenate([np.empty(0, np.int64), *sizes])
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(size) - size])
        self.size, self.pool = np.concatenate([self.size, size]), np.concatenate([self.pool, *ids])

    def learn(self, words: list[str]) -> None:
        """Adds distinct words that are not known. Letters and the last marks after them are words of their own to the
        tokenizer, so each such part is encoded once."""
        cut = [(b, w[len(b) :]) if (b := w.rstrip(MARKS)).isalpha() else (w, "") for w in words]
        new = [x for x in dict.fromkeys(x for two in cut for x in two) if x not in self.place]
        plain, other = [x for x in new if x.isalpha()], [x for x in new if not x.isalpha()]
        names, ids, sizes = [], [], []
        lists = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        for own, enc in zip(lists, self.tokenizer.encode_batch_fast([" ".join(x) for x in lists], add_special_tokens=False)):
            got = np.array(enc.ids, self.dtype)
            ends = np.flatnonzero(self.ends[got]) + 1
            if len(ends) == len(own):  # each word's own last token tells the words apart
                names += own
                ids.append(got)
                sizes.append(np.diff(ends, prepend=0))
            else:
                other += own
        for own, enc in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            names.append(own)
            ids.append(np.array(enc.ids, self.dtype))
            sizes.append(np.array([len(enc.ids)]))
        self.add(names, ids, sizes)
        two = [x for x in cut if x[1]]
        parts = np.fromiter((self.place[x] for xs in two for x in xs), np.int64, 2 * len(two))
        self.add([x + y for x, y in two], [gather(self.pool, self.first[parts], self.size[parts])], [self.size[parts].reshape(-1, 2).sum(axis=1)])


def words_apart(path: str) -> bool:
    """Whether a tokenizer file's rules never look across white space and drop it, so that a text's ids are those of its
    words; told from the rules themselves, as only the ones below are known to be so."""
    with open(path) as f:
        t = json.load(f)
    rules, cuts = (((t.get(k) or {}).get(v) or []) for k, v in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")))
    spaces = [r["type"] if r["type"] != "Replace" else (r["pattern"], r["content"]) for r in rules]
    return (
        spaces == ["NFC", ({"Regex": "\\s+"}, " "), "Lowercase"]
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["behavior"], cuts[0]["invert"], cuts[1]["add_prefix_space"], cuts[1]["use_regex"]) == ("Removed", True, False, False)
        and cuts[0]["pattern"] == {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
        and t["model"].get("end_of_word_suffix") == "</w>"
    )


class Encoder:
    """Ids of whole texts as the tokenizer gives them. Where its rules keep words apart (words_apart) the texts of a slice
    are split into words in Arrow, each distinct one is encoded once, and its ids are gathered."""

    _kept: dict = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.bits = max(1, int(size - 1).bit_length())
        self.dtype = np.uint16 if self.bits <= 16 else np.uint32
        self.words = Words(self.tokenizer, self.dtype) if words_apart(path) else None
        self.added = "|".join(sorted({re.escape(a.content.lower()) for a in self.tokenizer.get_added_tokens_decoder().values()}))

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """One for each worker process, kept between tasks."""
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def whole(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The library's own ids of each text."""
        ids = [np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, self.dtype) for x in texts.to_pylist()]
        return np.concatenate([np.empty(0, self.dtype), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow array of texts one after the other, and how many each text has. Null: none."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.words is None or not len(texts):
            return self.whole(texts)
        raw, start, end = text_buffers(texts)
        raw, off = spaced(_LOW[raw[start[0] : end[-1]]], np.append(start, end[-1]) - start[0])
        low = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(off), pa.py_buffer(raw))
        odd = pc.match_substring_regex(low, self.added) if self.added else None
        if odd is not None and pc.any(odd).as_py():  # the strings of added tokens are searched in whole texts
            (a, n), (b, m), odd = self.encode(pc.if_else(odd, "", texts)), self.whole(pc.filter(texts, odd)), odd.to_numpy(zero_copy_only=False)
            size = n.copy()
            size[odd] = m
            first = np.cumsum(n) - n
            first[odd] = len(a) + np.cumsum(m) - m
            return gather(np.concatenate([a, b]), first, size), size
        if len(self.words.place) > CACHE_WORDS:
            self.words.clear()
        lists = pc.split_pattern(low, " ")
        coded = lists.flatten().dictionary_encode()
        at = self.words.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        size = self.words.size[at]
        off = np.concatenate(([0], np.cumsum(size)))
        cuts = lists.offsets.to_numpy()
        return gather(self.words.pool, self.words.first[at], size), np.diff(off[cuts - cuts[0]])


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def slices(texts):
    """Row ranges of an Arrow array of texts with SLICE bytes at most, or one text."""
    _, start, end = text_buffers(texts)
    size = np.cumsum(end - start)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + SLICE, side="right")))
        yield a, b
        a = b


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, folder: str | None = None) -> DataFrame:
    """Writes every whole text of docs (doc_id, text) to shard files and returns their manifest: path, shard, n_docs,
    n_tokens and start (ids in the shards before it).

    doc_id is an integer. Order: doc_id ascending, null ids first; equal ids by a hash of the text. Null and empty texts hold
    the end id only. Repeated rows are written each. An empty table: no file. A text longer than a shard makes a larger
    one. Other columns of docs are ignored."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc = Encoder.of(tokenizer_path)
        part, seq, ids, pieces, ends, size = TaskContext.get().partitionId(), 0, [], [], [], 0
        store, top = _filesystem(folder)
        store.create_dir(top, recursive=True)

        def close():
            name = f"{top}/{part:05d}-{seq:05d}-{uuid.uuid4().hex}.plwm"
            with store.open_output_stream(name, compression=None) as f:
                f.write(dump(np.concatenate(pieces), ids, np.concatenate(ends)))
            return pa.RecordBatch.from_pydict({"path": [name], "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": [len(ids)], "n_tokens": [size]})

        for batch in batches:
            texts = batch.column(1)
            for a, b in slices(texts):
                got, n = enc.encode(texts.slice(a, b - a))
                got, n = np.insert(got, np.cumsum(n), enc.dtype(end_id)), n + 1
                stops, names, done = np.cumsum(n), batch.column(0).slice(a, b - a).to_pylist(), 0
                while done < len(stops):  # up to the first document that fills the shard
                    before = int(stops[done - 1]) if done else 0
                    to = min(len(stops), int(np.searchsorted(stops, before + shard_tokens - size)) + 1)
                    ids += names[done:to]
                    pieces.append(got[before : stops[to - 1]])
                    ends.append(size + stops[done:to] - before)
                    size, done = size + int(stops[to - 1]) - before, to
                    if size >= shard_tokens:
                        yield close()
                        seq, ids, pieces, ends, size = seq + 1, [], [], [], 0
        if ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    files = written(rows.mapInArrow(write, "path string, part int, seq int, n_docs long, n_tokens long"), "manifest")
    # Running sums within each task's files, and over the tasks: no window holds all files.
    tasks = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("files"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task
    tasks = tasks.select("part", F.coalesce(F.sum("tokens").over(over), F.lit(0)).alias("tokens"), F.coalesce(F.sum("files").over(over), F.lit(0)).alias("files"))
    own = Window.partitionBy("part").orderBy("seq")
    files = files.join(tasks, "part")
    return files.select("path", (F.col("files") + F.row_number().over(own) - 1).cast("int").alias("shard"), "n_docs", "n_tokens", (F.col("tokens") + F.sum("n_tokens").over(own) - F.col("n_tokens")).alias("start"), F.lit(folder).alias("folder"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """What the files of a manifest hold, one row for each document: doc_id, start, n_tokens, ids_crc32, shard. A task reads
    some files, one at a time."""

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for m in batch.to_pylist():
                store, _ = _filesystem(m["folder"])
                with store.open_input_stream(m["path"], compression=None) as f:
                    matrix, ids, ends = load(f.read())
                values = matrix.values().astype("<u4")
                starts = np.concatenate(([0], ends[:-1]))
                crc = [zlib.crc32(values[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(starts + m["start"], pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64()), pa.array([m["shard"]] * len(ids), pa.int32())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                )

    n, wide = manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.repartition(max(1, min(n, max(wide, n // 16)))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = written(write_tokens(docs, public_tokenizers.path("word_bpe_49k.json")), "manifest")
    return read_tokens(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")
