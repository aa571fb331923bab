"""Token ids as ORC files: sorted by document, with row indexes and Bloom filters on document ids.

A dataset is a folder with ``ids`` (ORC) and ``parts`` (Parquet, one row for each ORC file: its range of
keys, documents and ids, and the number of ids in the files before). ORC writes integers in run-length
encoding, cuts files into stripes that tasks read independently, and keeps the least and largest key and
a Bloom filter for each stretch of rows, so that a look-up of keys reads the stretches alone that can
hold them. Documents longer than ``CHUNK`` ids are several rows, so no row grows with a document.

Documents are in ascending order of the key, nulls first; rows of one key are in the order in which the
table's files hold them. A null text is empty and has the end id alone. Other columns are not carried.
An empty table gives a dataset without documents.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from quern.llm.storage import delete_at_end, shared_dir

#: The id that ends a document.
END = 2
#: Ids of a row at most.
CHUNK = 1 << 16
#: Characters that are cut into words at a time, as long as there is white space to cut at.
SEGMENT = 1 << 18
#: Bytes of texts that are taken together; a longer text is taken alone.
AT_ONCE = 2 << 20
#: Words that the library gets at a time.
NEW = 20_000
#: Entries of a worker's table of words, and their characters; what isn't in use goes when either is passed.
WORDS, WORD_CHARS = 400_000, 8 << 20
#: How the files are laid out.
LAYOUT = {
    "orc.bloom.filter.columns": "key",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.rows.between.memory.checks": "100",
    "orc.encoding.strategy": "COMPRESSION",
    "compression": "zstd",
}


#: Letters that composing leaves alone, each with one lower-case letter; words of them are one piece of the pattern.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[{LATIN}]+")
#: Marks behind a Latin letter that end what stands between blanks; the pattern cuts there in any case. Marks of
#: special tokens and the apostrophe aren't among them.
STOP = rf"([{LATIN}])([!-&(-/:;=?@\[-`{{}}~]+)([ \n]|$)"
#: Stands as a line between words that the library gets as one text.
MARK = "\x01"


class Encoder:
    """The library behind a table of words: what stands between blanks is encoded once and remembered.

    Words of Latin letters alone need no more of the library's steps than bytes and merges once they are
    in lower case, and a word's last id is one that ends a word. Others get all steps, with a mark
    between words. Either go to the library as lines of one text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        # both share the model; a letter of ASCII stands for its byte
        self.ascii, self.latin = Tokenizer(self.model.model), Tokenizer(self.model.model)
        lines, spelled = pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.ascii.pre_tokenizer, self.latin.pre_tokenizer = lines, pre_tokenizers.Sequence([lines, spelled])
        vocab = self.model.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.mark = self._encode(self.model, MARK)
        self._forget()

    @staticmethod
    def _encode(model, text: str) -> np.ndarray:
        return np.array(model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)

    def _forget(self) -> None:
        self.words: dict[str | None, int] = {None: 0}  # None stands for a text's end
        self.first, self.length = np.zeros(1 << 12, np.int32), np.ones(1 << 12, np.int32)
        self.pool = np.full(1 << 14, END, np.int32)
        self.chars, self.used = 0, 1

    def _put(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        at, n = len(self.words), len(words)
        while at + n > len(self.first):
            self.first, self.length = np.resize(self.first, 2 * len(self.first)), np.resize(self.length, 2 * len(self.length))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.first[at : at + n] = self.used + np.cumsum(lengths) - lengths
        self.length[at : at + n] = lengths
        self.pool[self.used : self.used + len(ids)] = ids
        self.words.update(zip(words, range(at, at + n)))
        self.used += len(ids)
        self.chars += sum(map(len, words))

    def _learn(self, words: list[str]) -> None:
        letters = list(filter(PLAIN.fullmatch, words))
        for model, some in (self.ascii, [w for w in letters if w.isascii()]), (self.latin, [w for w in letters if not w.isascii()]):
            ids = self._encode(model, "\n".join(some).lower())
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                self._put(some, ids, np.diff(ends, prepend=0))
        words = [w for w in words if w not in self.words]
        lines = [w for w in words if MARK not in w]
        ids = self._encode(self.model, "".join(f"{w}\n{MARK}\n" for w in lines))
        ends = np.flatnonzero(ids == self.mark[0])
        if len(self.mark) == 1 and len(ends) == len(lines):
            self._put(lines, np.delete(ids, ends), np.diff(ends, prepend=-1) - 1)
            words = [w for w in words if w not in self.words]
        if words:
            found = [e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)]
            self._put(words, np.fromiter(chain.from_iterable(found), np.int32), np.array([len(i) for i in found], dtype=np.int64))

    def _at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at some places of the table, and after how many ids each place ends."""
        length = self.length[place]
        after = np.cumsum(length, dtype=np.int32)
        at = np.repeat(self.first[place] - after + length, length)
        at += np.arange(len(at), dtype=np.int32)
        return self.pool[at], after

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the table has each of some distinct words. A full table keeps those of them that it has."""
        place = np.fromiter(map(self.words.get, words, repeat(-1)), np.int32, len(words))
        unknown = np.flatnonzero(place < 0).tolist()
        if unknown and (len(self.words) > WORDS or self.chars > WORD_CHARS):
            known = np.flatnonzero(place >= 0)
            ids, after = self._at(place[known])
            self._forget()
            self._put([words[k] for k in known.tolist()], ids, np.diff(after, prepend=0))
            place[known] = np.arange(1, len(known) + 1)
        if unknown:
            for k in range(0, len(unknown), NEW):
                self._learn([words[j] for j in unknown[k : k + NEW]])
            place[unknown] = [self.words[words[k]] for k in unknown]
        return place

    def ids(self, words: pa.Array | list[str], stops: np.ndarray | tuple = ()) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and where among them texts end. ``stops``: the number of words before each text's end."""
        coded = pa.array(words, pa.string()).dictionary_encode() if isinstance(words, list) else words.dictionary_encode()
        place = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        place = np.insert(place, np.asarray(stops, dtype=np.int64), 0)
        ids, after = self._at(place)
        return ids, after[place == 0].astype(np.int64)


def cut_all(texts: pa.Array) -> pa.ListArray:
    """For each text, what stands between white space of ASCII."""
    return pc.ascii_split_whitespace(pc.replace_substring_regex(texts, STOP, r"\1 \2\3"))


def cut(text: str) -> list[str]:
    return cut_all(pa.array([text]))[0].as_py()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)


def segments(text: str, limit: int = SEGMENT) -> Iterator[str]:
    """``text`` cut at blanks and line ends into pieces of about ``limit`` characters. White space is no
    part of any token and ends what the normaliser looks at, so the pieces' ids are the text's."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(" ", at, at + limit), text.rfind("\n", at, at + limit))
        if cut <= at:
            after = [k for k in (text.find(" ", at + limit), text.find("\n", at + limit)) if k >= 0]
            if not after:
                break
            cut = min(after)
        yield text[at:cut]
        at = cut
    yield text[at:]


def ranges(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with ``limit`` in all at most, or of a single one that has more."""
    after, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(after):
        stop = int(np.searchsorted(after, after[at] - sizes[at] + limit, side="right"))
        yield at, max(stop, at + 1)
        at = max(stop, at + 1)


def sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of each text."""
    return pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def stretches(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Neighbouring texts, or segments where one is long, of about ``AT_ONCE``, and which of them end a text."""
    if sizes(texts).max(initial=0) <= SEGMENT:
        for a, b in ranges(sizes(texts), AT_ONCE):
            yield texts.slice(a, b - a), np.ones(b - a, bool)
        return
    some, last, held = [], [], 0
    for text in texts:
        for piece in segments(text.as_py(), SEGMENT):
            if held > AT_ONCE:
                yield pa.array(some, pa.string()), np.array(last)
                some, last, held = [], [], 0
            some.append(piece)
            held += len(piece)
            last.append(False)
        last[-1] = True
    yield pa.array(some, pa.string()), np.array(last)


def encode(texts: pa.Array | list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts one after the other, each with the end id, and where each ends."""
    model, parts, stops, total = encoder(path), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
    texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
    for some, last in stretches(texts):
        words = cut_all(some)
        ids, ends = model.ids(words.flatten(), words.offsets.to_numpy()[1:][last])
        parts.append(ids)
        stops.append(ends + total)
        total += len(ids)
    return np.concatenate(parts), np.concatenate(stops)


def write(docs: DataFrame, where: str, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Encode ``docs`` and write them as a dataset to ``where``, which executors share."""
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    in_order = slim.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("key", "text")
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, first = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for at, after in ranges(sizes(batch.column(1)), AT_ONCE):
                some = batch.slice(at, after - at)
                ids, stops = encode(some.column(1), path)
                rows, begin = [], 0
                for k, stop in enumerate(stops.tolist()):
                    cuts = range(begin, stop, CHUNK)
                    rows += [(k, part, place, c, c == len(cuts) - 1, first + a, min(CHUNK, stop - a)) for c, a in enumerate(cuts)]
                    begin, place = stop, place + 1
                columns = list(zip(*rows))
                keys = some.column(0).take(pa.array(columns[0], pa.int32()))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *columns[6]]), pa.int32()), pa.array(ids))
                types = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, t) for c, t in zip(columns[1:], types)), lists], names=out.names)
                first += len(ids)

    out = T.StructType([
        T.StructField("key", kind), T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("chunk", T.IntegerType()),
        T.StructField("last", T.BooleanType()), T.StructField("first", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])
    in_order.mapInArrow(run, out).write.options(**LAYOUT).orc(f"{where}/ids")
    files = docs.sparkSession.read.schema(out).orc(f"{where}/ids")
    parts = files.groupBy("part").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.sum((F.col("chunk") == 0).cast("long")).alias("docs"), F.sum("n").alias("n"), F.bool_or(F.col("key").isNull()).alias("nulls"))
    # one row for each file
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts.withColumn("start", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{where}/parts")


def read(spark: SparkSession, where: str) -> DataFrame:
    """The rows of the ORC files: ``key``, ``part``, ``place``, ``chunk``, ``last``, ``first``, ``n``, ``ids``."""
    return spark.read.orc(f"{where}/ids")


def read_parts(spark: SparkSession, where: str) -> DataFrame:
    return spark.read.parquet(f"{where}/parts")


def lookup(spark: SparkSession, where: str, keys: list) -> DataFrame:
    """(``key``, ``part``, ``place``, ``ids``) of the documents of some keys. The filter reaches the ORC
    reader, which leaves out stripes and stretches by their ranges and Bloom filters."""
    rows = read(spark, where).filter(F.col("key").isin(list(keys)))
    pieces = F.array_sort(F.collect_list(F.struct("chunk", "ids")))
    return rows.groupBy("key", "part", "place").agg(F.flatten(F.transform(pieces, lambda p: p["ids"])).alias("ids"))


def joined_crc(pieces: list[tuple[int, int]]) -> int:
    """The crc32 of a whole from (crc32, bytes) of its pieces in order. The checksum is linear, so
    what zeros do to the first part's value makes room for the second's."""
    total = 0
    for crc, size in pieces:
        zeros = bytes(size)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def documents(spark: SparkSession, where: str) -> DataFrame:
    """(``key``, ``start``, ``n_tokens``, ``ids_crc32``) of each document, from the files. Stripes are read in
    parallel; documents of several rows get their checksum from those of the rows."""
    rows = read(spark, where)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(6)
            ends = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(crc, pa.int64()), pa.array(np.diff(ends).astype(np.int64))], names=out.names)

    head = rows.select("key", "part", "place", "chunk", "last", "first", "ids")
    out = T.StructType([*head.schema.fields[:6], T.StructField("crc", T.LongType()), T.StructField("n", T.LongType())])
    # either filter reaches the ORC reader, which leaves out stretches without a long document
    whole = head.filter("chunk = 0 and last").mapInArrow(sums, out).select("key", "part", "first", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))

    def join(table: pa.Table) -> pa.Table:
        got = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        crc = joined_crc([(r["crc"], 4 * r["n"]) for r in got])
        first = table.filter(pa.compute.equal(table["chunk"], 0))
        return pa.table([first["key"], first["part"], first["first"], pa.array([sum(r["n"] for r in got)], pa.int64()), pa.array([crc], pa.int64())], names=["key", "part", "first", "n_tokens", "ids_crc32"])

    many = head.filter("chunk > 0 or not last").mapInArrow(sums, out).groupBy("part", "place").applyInArrow(join, whole.schema)
    starts = read_parts(spark, where).select("part", "start")
    return whole.union(many).join(starts, "part").select("key", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` to a folder of their own in the shared one, which goes when the application
    ends, and read the documents back: ``key``, ``start``, ``n_tokens``, ``ids_crc32``."""
    spark = docs.sparkSession
    where = f"{shared_dir(spark)}/quern/token-files-{uuid.uuid4().hex}"
    delete_at_end(spark, where)
    write(docs, where, path, key, text)
    return documents(spark, where).withColumnRenamed("key", key)
