"""Byte-level BPE (operator 3): a sentencepiece model made directly from a ranked vocabulary.

Every vocabulary entry becomes a piece: its bytes mapped one to one to printable characters, its score the
negative rank, so that sentencepiece merges in rank order. The normaliser is the identity. A text is cut into
pre-tokens by the public pattern; each is mapped to characters and encoded separately. Decoding maps pieces back to
bytes. The model is not trained, only written down.

Cases: a null or empty text has no ids and decodes to no bytes. Texts of any length are encoded whole, slice by slice of a
batch. Equal rows are encoded alike and repeated ids do not matter. Of two ways to merge, the lower rank wins, then the left one;
there are no other ties. An empty table gives no rows. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import Recent, documents, map_texts, released, strings, unpacked, valid

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHED_CHUNKS = 250_000  # in each of two generations
_coders: dict[str, Coder] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """A character for each byte: printable Latin-1 ones stand for themselves, the others for code points from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file in order of rank; ranks must be 0, 1, 2 ..."""
    with open(path, "rb") as file:
        ranks = {int(r): base64.b64decode(token) for token, r in map(bytes.split, file.read().splitlines())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks have gaps")
    return [ranks[i] for i in range(len(ranks))]


def model_bytes(entries: list[bytes]) -> bytes:
    """A serialised sentencepiece model: piece i is entry i, its score -i; the unknown piece comes last."""
    letters = byte_characters()
    out = []
    for rank, entry in enumerate(entries):
        piece = "".join(letters[b] for b in entry).encode()
        score = np.float32(-rank).tobytes()
        out.append(_field(1, _field(1, piece) + _varint(2 << 3 | 5) + score + _field(3, 1)))  # 3: NORMAL
    out.append(_field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + np.float32(0).tobytes() + _field(3, 2)))  # UNKNOWN
    # trainer: model type BPE (3: 2), vocabulary size (4), ids of special pieces (40 to 43), none but unknown
    none = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, len(entries) + 1) + _field(40, len(entries))
    trainer += _field(41, none) + _field(42, none) + _field(43, none)
    # normaliser: identity, no character map, no dummy prefix, keep and do not escape white space
    normaliser = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


class Coder:
    """Encodes and decodes with one model.

    Between two characters that are not white space, a single space always starts a new pre-token, so a text is cut there
    and the distinct chunks of a slice are encoded once. A chunk of Latin letters and a tail of plain marks is
    two pre-tokens; the pattern cuts all others. Known chunks are held in bounded caches of the Python worker.
    """

    cut = re.compile(r"(?<=\S) (?=\S)")
    ragged = r"^$|^[\s\x0b\x1c-\x1f\x{85}\pZ]|[\s\x0b\x1c-\x1f\x{85}\pZ]$"
    letters = "^[A-Za-zÀ-ÖØ-öø-ÿŒœ]+$"
    marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        import public_tokenizers
        import regex
        import sentencepiece

        self.entries = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.entries))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.mapped = dict(enumerate(byte_characters()))
        self.sizes = np.fromiter(map(len, self.entries), np.int64, len(self.entries))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.entries), np.uint8)
        self.words: dict[str, bytes] = Recent(cached)
        self.others: dict[str, bytes] = Recent(cached)

    def pieces(self, pre_tokens: list[str]) -> list[list[int]]:
        mapped = [t.encode().decode("latin-1").translate(self.mapped) for t in pre_tokens]
        return self.model.encode(mapped, num_threads=1)

    def _learn_words(self, words: list[str]) -> None:
        found = self.pieces([" " + w for w in words])
        self.words.update(zip(words, (np.array(ids, "<i4").tobytes() for ids in found)))

    def _learn_others(self, chunks: list[str]) -> None:
        found = [self.pattern.findall(c) for c in chunks]
        flat = self.pieces([t for f in found for t in f])
        at = 0
        for chunk, f in zip(chunks, found):
            self.others[chunk] = np.array([i for ids in flat[at : at + len(f)] for i in ids], "<i4").tobytes()
            at += len(f)

    def _known(self, cache: dict[str, bytes], chunks: list[str], learn) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks set end to end, and how many each has."""
        new = sorted(cache.absent(set(chunks)))
        if new:
            learn(new)
        found = [cache[c] for c in chunks]
        return np.frombuffer(b"".join(found), "<i4"), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def _encode_one(self, text: str) -> np.ndarray:
        first, *rest = self.cut.split(text)
        return self._known(self.others, [first, *[" " + c for c in rest]], self._learn_others)[0]

    def encode(self, column: pa.Array) -> pa.Array:
        """The ids of each text, as lists."""
        column = valid(column)
        split = pc.split_pattern(column, " ")
        bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        runs, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        odd = pc.match_substring_regex(runs, self.ragged).to_numpy(zero_copy_only=False)
        ragged = np.add.reduceat(odd[at], bounds[:-1]) > 0 if len(bounds) > 1 else np.zeros(0, bool)
        # A run is a word of letters and a tail of marks, or (its word then left out) anything else.
        cores = pc.utf8_rtrim(runs, self.marks)
        plain = pc.match_substring_regex(cores, self.letters).to_numpy(zero_copy_only=False)
        words = cores.filter(pa.array(plain)).dictionary_encode()
        word_ids, word_sizes = self._known(self.words, strings(words.dictionary), self._learn_words)
        cut = np.where(plain, pc.binary_length(cores).to_numpy(), 0)
        has = (pc.binary_length(runs).to_numpy() > cut) & ~odd
        rest = [r.encode()[c:].decode() if c else " " + r for r, c in zip(strings(runs.filter(pa.array(has))), cut[has].tolist())]
        firsts = strings(runs.take(pa.array(at[bounds[:-1]])))
        others = pa.array(rest + [f if not r else "" for f, r in zip(firsts, ragged)], pa.string()).dictionary_encode()
        other_ids, other_sizes = self._known(self.others, strings(others.dictionary), self._learn_others)
        of_other = others.indices.to_numpy()
        # Where the two parts of each run, and then of the first run of each text, lie in the table of all known ids.
        table = np.concatenate([word_ids, other_ids])
        word_starts, other_starts = np.cumsum(word_sizes) - word_sizes, np.cumsum(other_sizes) - other_sizes + len(word_ids)
        n, m = len(runs), len(firsts)
        sizes, starts = np.zeros((n + m, 2), np.int64), np.zeros((n + m, 2), np.int64)
        where = np.flatnonzero(plain)
        sizes[where, 0], starts[where, 0] = (a[words.indices.to_numpy()] for a in (word_sizes, word_starts))
        where = np.concatenate([np.flatnonzero(has), np.arange(n, n + m)])
        sizes[where, 1], starts[where, 1] = other_sizes[of_other], other_starts[of_other]
        at[bounds[:-1]] = np.arange(n, n + m)
        size = np.where(np.repeat(ragged, np.diff(bounds))[:, None], 0, sizes[at]).ravel()
        stops = np.cumsum(size)
        ids = table[np.repeat(starts[at].ravel() - (stops - size), size) + np.arange(int(size.sum()))]
        ends = np.concatenate([[0], stops[1::2]])[bounds]
        if ragged.any():  # white space that the cut at single spaces does not fit
            texts = strings(column)
            parts = [self._encode_one(texts[i]) if r else ids[ends[i] : ends[i + 1]] for i, r in enumerate(ragged.tolist())]
            ids, ends = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        stops = np.cumsum(sizes)
        return self.bytes[np.repeat(self.starts[ids] - (stops - sizes), sizes) + np.arange(int(sizes.sum()))].tobytes()


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text", keep=None) -> DataFrame:
    """``row`` (the kept columns) and ``ids``, the token ids of the whole text."""
    path = vocabulary or vocabulary_path()

    def make():
        return lambda texts: {"ids": coder(path).encode(texts)}

    return map_texts(docs, make, "ids array<int>", text, keep, arrow=True)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The same rows with ``decoded``, the bytes that the column ``ids`` stands for; null ids decode to no bytes."""
    from pyspark.sql import types as T

    path = vocabulary or vocabulary_path()
    names = encoded.columns
    place = names.index("ids")

    def work(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                lists = pc.fill_null(part.column(place), [])
                ids, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                made = [coder(path).decode(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary())], [*names, "decoded"])

    return encoded.mapInArrow(released(work), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(coded: DataFrame) -> DataFrame:
    """Counts and hashes of ids and decoded bytes, beside the kept columns."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return unpacked(
        coded,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(decode(encode(documents(spark, sf_dir), keep=["doc_id"])))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids, their number and the hash of the bytes that they decode to."""
    coded = decode(encode(docs, keep=["doc_id", "lang", "source"]))
    return unpacked(coded, F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
