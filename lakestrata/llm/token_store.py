"""Token-id store (operator 1): texts as token ids in compressed binary blocks with random access to a document.

Format (version 1): a folder of Parquet files whose rows are blocks. A block holds consecutive documents of one
shard: ``frames``, one zstandard frame per document set end to end, each the ids as little-endian unsigned 32-bit
numbers compressed with the shared dictionary; ``frame_ends``, the byte offset at which each frame ends;
``doc_ids`` and ``lengths`` (ids per document); ``dictionary``, the SHA-256 of the dictionary; ``shard``, ``block``
and ``shard_start``, the ids before the block in its shard. Shards are ranges of the document id, in order.
The dictionary is a one-row Parquet table beside them. A reader refuses a block of another dictionary. One
document is read by its id: Parquet statistics on ``first_doc`` and ``last_doc`` skip other row groups, the offsets give the
frame's bytes, and only that frame is decompressed.

Cases: a null or empty text has the end id only; a text of any length is one frame. Rows with one id are ordered by text,
null first; equal rows are a document each; a null id comes before all others. An empty table gives a store without blocks.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import Recent, documents, in_share, named, released, ship, slices, strings, valid
from lakestrata.session import scratch_path

VERSION = 1
BLOCK_BYTES = 1 << 20  # a block is closed once its ids reach this size
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCUMENTS = 2_000  # the dictionary is trained on at most so many texts ...
SAMPLE_TEXT_BYTES = 8 << 10  # ... none longer than this: it serves short documents
SLICE = 4 << 20  # bytes of text whose words are made distinct together
CACHED_WORDS = 250_000  # in each of two generations
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
BLOCKS = (
    "version int, dictionary string, shard int, block int, shard_start long, first_doc long, last_doc long,"
    " doc_ids array<bigint>, lengths array<int>, frame_ends array<int>, frames binary"
)

_encoders: dict[str, WordEncoder] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes whole texts with the tokenizers library, asking it once for each distinct word.

    The vocabulary's pre-tokenizer drops white space, so the ids of a text are those of its runs without white
    space, one after the other. A run of Latin letters followed by plain punctuation is two pre-tokens, so its ids
    are those of the two, and letters are lower-cased first. Words of a slice are made distinct by Arrow; ids of
    known words are held in a bounded cache that a Python worker keeps between tasks. A text that holds a
    marker of the vocabulary, such as ``<|endoftext|>``, in any case of letters, is encoded by the library as a whole: markers
    are tokens of their own there, as they are by default.
    """

    letters = "^[A-Za-zÀ-ÖØ-öø-ÿŒœ]+$"  # precomposed, so normalisation leaves them, and lower-cased one by one
    marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # a run of these is one pre-token

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.words: dict[str, bytes] = Recent(cached)
        self.others: dict[str, bytes] = Recent(cached // 4)
        self.markers = sorted({t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()})
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, np.uint32) for e in found]

    def _learn_words(self, words: list[str]) -> None:
        """Ids of words of letters: encoded as one text and cut after each token that ends a word."""
        ids = self.ids([" ".join(words)])[0]
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words) or cuts[-1] != len(ids):
            self.words.update(zip(words, (part.tobytes() for part in self.ids(words))))
            return
        whole, stops = ids.tobytes(), (4 * cuts).tolist()
        self.words.update(zip(words, (whole[a:b] for a, b in zip([0, *stops], stops))))

    def _known(self, cache: dict[str, bytes], strings: list[str], learn) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct strings set end to end, and how many each has."""
        new = sorted(cache.absent(set(strings)))
        if new:
            learn(new)
        found = [cache[s] for s in strings]
        return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def _learn_others(self, runs: list[str]) -> None:
        self.others.update(zip(runs, (part.tobytes() for part in self.ids(runs))))

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        column = valid(column)
        marked = np.zeros(len(column), bool)
        for marker in self.markers:
            marked |= pc.match_substring(column, marker, ignore_case=True).to_numpy(zero_copy_only=False)
        found = self._encode_words(pc.if_else(pa.array(marked), "", column) if marked.any() else column)
        for i in np.flatnonzero(marked).tolist():
            found[i] = self.ids([column[i].as_py()])[0].tobytes()
        return found

    def _encode_words(self, column: pa.Array) -> list[bytes]:
        split = pc.ascii_split_whitespace(column)
        coded = split.flatten().dictionary_encode()
        runs, at = coded.dictionary, coded.indices.to_numpy()
        # A run is a word of letters and a tail of marks, or (its word then left out) anything else.
        cores = pc.utf8_rtrim(runs, self.marks)
        plain = pc.match_substring_regex(cores, self.letters).to_numpy(zero_copy_only=False)
        words = pc.utf8_lower(cores).filter(pa.array(plain)).dictionary_encode()
        word_ids, word_sizes = self._known(self.words, strings(words.dictionary), self._learn_words)
        cut = np.where(plain, pc.binary_length(cores).to_numpy(), 0)
        has = pc.binary_length(runs).to_numpy() > cut
        rest = [r.encode()[c:].decode() if c else r for r, c in zip(strings(runs.filter(pa.array(has))), cut[has].tolist())]
        others = pa.array(rest, pa.string()).dictionary_encode()
        other_ids, other_sizes = self._known(self.others, strings(others.dictionary), self._learn_others)
        # Where the two parts of each run lie in the table of all known ids.
        table = np.concatenate([word_ids, other_ids])
        sizes, starts = np.zeros((len(runs), 2), np.int64), np.zeros((len(runs), 2), np.int64)
        sizes[plain, 0] = word_sizes[words.indices.to_numpy()]
        starts[plain, 0] = (np.cumsum(word_sizes) - word_sizes)[words.indices.to_numpy()]
        sizes[has, 1] = other_sizes[others.indices.to_numpy()]
        starts[has, 1] = (np.cumsum(other_sizes) - other_sizes + len(word_ids))[others.indices.to_numpy()]
        size = sizes[at].ravel()
        stops = np.cumsum(size)
        ids = table[np.repeat(starts[at].ravel() - (stops - size), size) + np.arange(int(size.sum()))].tobytes()
        bounds = np.concatenate([[0], stops[1::2]])[split.offsets.to_numpy() - split.offsets[0].as_py()] * 4
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def train_dictionary(docs: DataFrame, path: str, end_id: int = END_ID, text: str = "text") -> bytes:
    """A zstandard dictionary from a bounded sample of short documents; it changes sizes, never results.

    One task encodes the sample and trains; only the dictionary reaches the driver. With too little to train
    on, the dictionary is raw: the ids of the sample.
    """
    ship(docs.sparkSession)
    short = docs.select(named(text).alias("text")).filter(F.octet_length("text").between(1, SAMPLE_TEXT_BYTES))
    # A bound on the hash leaves about four times the sample of all rows, however many tasks there are; the smallest are taken.
    few = short.filter(in_share(F.xxhash64("text"), 4 * SAMPLE_DOCUMENTS, docs.count()))
    sample = few.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_DOCUMENTS).coalesce(1)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        end = np.uint32(end_id).tobytes()
        samples = [ids + end for b in batches for ids in encoder(path).encode(b.column(0))]
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            made = b"".join(samples)[:DICTIONARY_BYTES] or end
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["dictionary"])

    return bytes(sample.mapInArrow(train, "dictionary binary").first()["dictionary"])


def write_store(
    docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, text: str = "text", level: int = 3
) -> str:
    """Encode every text, append the end id and write the store below ``path``; returns ``path``.

    One shuffle of the texts by range of id; each task then writes one shard in order of id.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = vocabulary or vocabulary_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    dictionary = train_dictionary(rows, vocabulary, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(VERSION, digest, bytearray(dictionary))], "version int, sha256 string, bytes binary").write.parquet(
        f"{path}/dictionary"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=level)
        compress = zstandard.ZstdCompressor(dict_data=shared, write_content_size=True).compress
        end, shard = np.uint32(end_id).tobytes(), TaskContext.get().partitionId()
        names = [c.strip().split()[0] for c in BLOCKS.split(",")]
        ids_, lengths, frames, size, block, start = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal ids_, lengths, frames, size, block, start
            ends = np.cumsum([len(f) for f in frames])
            known = [i for i in ids_ if i is not None]
            values = [VERSION, digest, shard, block, start, known[0] if known else None, known[-1] if known else None]
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array([v], k) for v, k in zip(values, kinds)]
            arrays += [
                pa.array([ids_], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int32())),
                pa.array([ends], pa.list_(pa.int32())),
                pa.array([b"".join(frames)], pa.binary()),
            ]
            block, start = block + 1, start + sum(lengths)
            ids_, lengths, frames, size = [], [], [], 0
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for first, n in slices(batch.column(1), SLICE):
                part = batch.slice(first, n)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder(vocabulary).encode(part.column(1))):
                    ids += end
                    ids_.append(doc_id)
                    lengths.append(len(ids) // 4)
                    frames.append(compress(ids))
                    size += len(ids)
                    if size >= BLOCK_BYTES:
                        yield flush()
        if ids_:
            yield flush()

    ranged = rows.repartitionByRange(_shards(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ranged.mapInArrow(released(write), BLOCKS).write.parquet(f"{path}/blocks")
    return path


def _shards(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_store(spark: SparkSession, path: str) -> tuple[DataFrame, bytes]:
    """The blocks and the dictionary of a store."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["bytes"])
    if row["version"] != VERSION or hashlib.sha256(dictionary).hexdigest() != row["sha256"]:
        raise ValueError(f"{path} has another version or a damaged dictionary")
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks"), dictionary


def _decompressor(dictionary: bytes):
    import zstandard

    digest = hashlib.sha256(dictionary).hexdigest()
    decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress

    def frames_of(block: dict) -> Iterator[tuple[int, int | None, bytes]]:
        """(place in block, document, its ids)."""
        if block["version"] != VERSION or block["dictionary"] != digest:
            raise ValueError(f"block {block['block']} of shard {block['shard']} needs dictionary {block['dictionary']}")
        begin, frames = 0, memoryview(block["frames"])
        for i, (doc_id, n, stop) in enumerate(zip(block["doc_ids"], block["lengths"], block["frame_ends"])):
            ids = decompress(frames[begin:stop])
            if len(ids) != 4 * n:
                raise ValueError(f"document {doc_id} has {len(ids) // 4} ids, its index says {n}")
            yield i, doc_id, ids
            begin = stop

    return frames_of


def shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each shard: a running sum over one row per shard."""
    sums = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, n_bytes."""
    ship(spark)
    blocks, dictionary = open_store(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames_of = _decompressor(dictionary)
        for batch in batches:
            for block in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                lengths = np.asarray(block["lengths"], np.int64)
                starts = block["shard_start"] + np.cumsum(lengths) - lengths
                crcs = [zlib.crc32(ids) for _, _, ids in frames_of(block)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block["shard"]] * len(crcs), pa.int32()),
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(crcs, pa.int64()),
                        pa.array(np.diff(np.concatenate([[0], block["frame_ends"]])), pa.int64()),
                    ],
                    ["shard", "doc_id", "at", "n_tokens", "ids_crc32", "n_bytes"],
                )

    found = blocks.mapInArrow(read, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long, n_bytes long")
    return found.join(shard_starts(blocks), "shard").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "n_bytes"
    )


def read_ids(spark: SparkSession, path: str, doc_id: int | None = None) -> DataFrame:
    """doc_id and ids of all documents, or of one: then only its block is read and only its frame decompressed."""
    ship(spark)
    blocks, dictionary = open_store(spark, path)
    if doc_id is not None:
        blocks = blocks.filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        frames_of = _decompressor(dictionary)
        one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress
        for batch in batches:
            for block in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if doc_id is None:
                    found = [(d, ids) for _, d, ids in frames_of(block)]
                else:
                    if block["dictionary"] != hashlib.sha256(dictionary).hexdigest():
                        raise ValueError(f"block {block['block']} needs dictionary {block['dictionary']}")
                    ends = [0, *block["frame_ends"]]
                    wanted = [i for i, d in enumerate(block["doc_ids"]) if d == doc_id]
                    found = [(doc_id, one(block["frames"][ends[i] : ends[i + 1]])) for i in wanted]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in found], pa.int64()),
                        pa.array([np.frombuffer(ids, "<u4").astype(np.int32) for _, ids in found], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "ids"],
                )

    return blocks.mapInArrow(read, "doc_id long, ids array<int>")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_store(documents(spark, sf_dir), scratch_path(spark, "token-store"))
    return read_store(spark, path)
