"""Substring dedup (operator 9): long word sequences that occur again, found on a compacted de Bruijn graph.

Edges of the graph are runs of ``k`` words (k-mers, 20 by default). They are never shuffled one by one: the
edges of a document that share their minimizer (the smallest hash of six words inside) follow each other without
a branch and travel as one compact edge with two 64-bit hashes of all its words and its source coordinates. Equal
k-mers have equal minimizers at the same place, so every repeated edge meets its other occurrences under its
minimizer:

1. Compact edges are combined inside each task, dealt out by minimizer and sorted. Edges whose minimizer
   occurs once are dropped. An occurrence that is not the first of its compact edge is a repeat of the first.
2. Where compact edges of one minimizer differ, paths may branch inside them: the first occurrence of each is
   opened into its single k-mers, which are dealt out by hash and compared in the same way.
3. Repeats that follow each other in a document, as their sources do in theirs, are joined into one unbranched
   path: a span with its source coordinates. Spans are joined with the texts, and words they cover are removed.

4. Each span is verified by its words: both the texts that have it and those it is said to come from give a
   128-bit digest of the words at their coordinates, and all digests of one source must agree. A span whose words
   differ from the source's is dropped.

Cases: null, empty or short texts have no edges and keep all words. Documents come in order of id, a null id
first; rows with one id but different texts are different documents, told apart by 64-bit hashes of the texts, in their
order; identical rows are one document and get one result. Texts of any length are read whole, in slices. A very common
passage is combined in each task before the shuffle, and its surplus occurrences are dealt out evenly, so no task receives
them all. An empty table gives no rows. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import as_bytes, documents, named, released, ship, slices, stored
from lakestrata.llm.words import Words, mix, window_hashes

K = 20
ANCHOR = 6  # words of a minimizer
COMBINED = 1_000_000  # compact edges that a task combines at once
NO_ID = -(1 << 63)
# An edge under its minimizer k has its hashes y and z, and q is -1; a repeat whose source is known, dealt out by any k,
# has the source's coordinates in y, z and q.
EDGE = "k long, y long, z long, d long, f long, p long, q long"
FOUND = "kind int, d long, f long, p long, sd long, sf long, sp long"
_names = [f.split()[0] for f in EDGE.split(", ")]
_Q1, _Q2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


# Coordinates: d is the document's id, f the hash of its text; p packs the first word and the number of edges (4 bits).
def fingerprint(text: Column) -> Column:
    return F.coalesce(F.xxhash64(text), F.lit(0))


def _first(p: str) -> Column:
    return F.shiftrightunsigned(p, 4)


def _count(p: str) -> Column:
    return F.col(p).bitwiseAND(F.lit(15))


class _Spans:
    """Hashes of any run of words of a slice, from running sums."""

    def __init__(self, hashes: np.ndarray):
        self.sums = []
        for q in (_Q1, _Q2):
            powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(len(hashes) - 1, 0), q)]))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[: len(hashes)])])
            inverse = np.uint64(pow(int(q), -1, 1 << 64))
            back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(hashes), inverse)]))
            self.sums.append((sums, back))

    def hash(self, which: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        sums, back = self.sums[which]
        return mix((sums[stop] - sums[start]) * back[start] + (stop - start).astype(np.uint64))


def compact_edges(words: Words, k: int) -> tuple[np.ndarray, ...]:
    """(first word, edges, minimizer, hash, second hash) of each run of edges with one minimizer."""
    hashes = words.hashes()
    empty = np.zeros(0, np.int64)
    if len(hashes) < k:
        return (empty,) * 5
    anchor = min(ANCHOR, k)
    grams = window_hashes(hashes, anchor)
    views = np.lib.stride_tricks.sliding_window_view(grams, k - anchor + 1)
    place = views.argmin(axis=1) + np.arange(len(views))
    inside = words.owner[: len(views)] == words.owner[k - 1 :]
    new = np.ones(len(views), bool)
    new[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new & inside)
    if not len(start):
        return (empty,) * 5
    stop = np.append(start[1:], len(views))
    ends = np.cumsum(inside)  # edges end where the text does
    n = ends[stop - 1] - ends[start] + 1
    spans = _Spans(hashes)
    last = start + n + k - 1
    return start, n, grams[place[start]], spans.hash(0, start, last), spans.hash(1, start, last)


def _combine(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Among equal edges only the first goes under its minimizer; the others know their source already."""
    m, c, x, d, f, p = columns
    order = np.lexsort((p, f, d, x, c, m))
    m, c, x, d, f, p = (a[order] for a in (m, c, x, d, f, p))
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | (c[1:] != c[:-1]) | (x[1:] != x[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(m)), 0))
    again = (d != d[first]) | (f != f[first]) | (p != p[first])
    spread = mix((d.view(np.uint64) * _Q1) ^ (f.view(np.uint64) * _Q2) ^ p.view(np.uint64)).view(np.int64)
    one = new | again  # an identical row is the same occurrence
    source = (np.where(again, a[first], b) for a, b in ((d, c), (f, x), (p, np.int64(-1))))
    y, z, q = source
    return [a[one] for a in (np.where(again, spread, m), y, z, d, f, p, q)]


def _edge_rows(parts: Iterator[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    held: list[list[np.ndarray]] = []
    size = 0

    def flush():
        for_all = _combine([np.concatenate(c) for c in zip(*held)])
        for lo in range(0, len(for_all[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(a[lo : lo + (1 << 16)], pa.int64()) for a in for_all], _names)

    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= COMBINED:
            yield from flush()
            held, size = [], 0
    if size:
        yield from flush()


def _from_texts(batches, k: int) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        d, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for lo, n in slices(batch.column(2)):
            words = Words(as_bytes(batch.column(2).slice(lo, n)))
            start, edges, m, c, x = compact_edges(words, k)
            owner = words.owner[start]
            p = (start - words.first[owner]) << 4 | edges
            yield [a.astype(np.uint64).view(np.int64) for a in (m, c, x)] + [d[lo : lo + n][owner], f[lo : lo + n][owner], p]


def _from_checks(batches, k: int) -> Iterator[list[np.ndarray]]:
    """The single edges of compact ones that have to be opened."""
    for batch in batches:
        d, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for lo, n in slices(batch.column(2)):
            words = Words(as_bytes(batch.column(2).slice(lo, n)))
            spans = _Spans(words.hashes())
            firsts, owners = [], []
            for i, opened in enumerate(batch.column(3).slice(lo, n).to_pylist()):
                for s, e in (tuple(o.values()) for o in opened):
                    firsts.append(np.arange(s, e))
                    owners.append(np.full(e - s, i))
            if not firsts:
                continue
            first, owner = np.concatenate(firsts), np.concatenate(owners)
            at = first + words.first[owner]
            m, x = (spans.hash(i, at, at + k).view(np.int64) for i in (0, 1))
            yield [m, m, x, d[lo : lo + n][owner], f[lo : lo + n][owner], first << 4 | 1]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From edges sorted by (k, y, z, d, f, p): repeats with their source (kind 0), and the first occurrences of
    edges that share their minimizer with other edges (kind 1). Keeps one row between batches."""
    state = {"m": None, "class": None, "first": (0, 0, 0), "many": False, "held": None}

    def rows(kind, *coordinates):
        arrays = [pa.array(np.full(len(coordinates[0]), kind, np.int32))] + [pa.array(a, pa.int64()) for a in coordinates]
        return pa.RecordBatch.from_arrays(arrays, ["kind", "d", "f", "p", "sd", "sf", "sp"])

    for batch in batches:
        table = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
        known = table[6] >= 0
        if known.any():
            yield rows(0, *(table[i][known] for i in (3, 4, 5, 1, 2, 6)))
        m, c, x, d, f, p = (a[~known] for a in table[:6])
        if not len(m):
            continue
        old = state["m"] == m[0]
        same = old and state["class"] == (c[0], x[0])
        new_m = np.ones(len(m), bool)
        new_m[1:] = m[1:] != m[:-1]
        new_class = new_m.copy()
        new_class[1:] |= (c[1:] != c[:-1]) | (x[1:] != x[:-1])
        new_m[0], new_class[0] = not old, not same
        at = np.maximum.accumulate(np.where(new_class, np.arange(len(m)), -1))
        sd, sf, sp = (np.where(at < 0, state["first"][i], a[at]) for i, a in enumerate((d, f, p)))
        again = (d != sd) | (f != sf) | (p != sp)
        yield rows(0, *(a[again] for a in (d, f, p, sd, sf, sp)))
        group = np.cumsum(new_m)  # 0: goes on from the batch before
        classes = np.bincount(group[new_class], minlength=group[-1] + 1)
        if old:
            classes[0] += 2 if state["many"] else 1
        if state["held"] and old and classes[0] > 1:
            yield rows(1, *([v] for v in (*state["held"], *state["held"])))
        many = classes[group] > 1
        found = new_class & many
        if found.any():
            yield rows(1, *(a[found] for a in (d, f, p)), *(a[found] for a in (d, f, p)))
        last = int(group[-1])
        single = classes[last] == 1
        if single and (last > 0 or not old):
            state["held"] = (int(sd[-1]), int(sf[-1]), int(sp[-1]))
        elif not single:
            state["held"] = None
        state |= {"m": m[-1], "class": (c[-1], x[-1]), "first": (int(sd[-1]), int(sf[-1]), int(sp[-1])), "many": not single}


def _compared(edges: DataFrame) -> DataFrame:
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = edges.repartition(n, "k").sortWithinPartitions("k", "y", "z", "d", "f", "p")
    return dealt.mapInArrow(released(_occurrences), FOUND)


def _paths(repeats: DataFrame) -> DataFrame:
    """Neighbouring repeats whose sources are neighbours too, joined: edges ``s`` to ``e`` of a document repeat those
    from ``ss`` on of document ``sd``."""
    parts = repeats.select(
        "d", "f", _first("p").alias("s"), (_first("p") + _count("p")).alias("e"), "sd", "sf", _first("sp").alias("ss")
    )
    order = Window.partitionBy("d", "f").orderBy("s", "e")
    before = lambda c: F.lag(c).over(order)
    goes_on = (
        (F.col("s") == before("e"))
        & (F.col("sd") == before("sd"))
        & (F.col("sf") == before("sf"))
        & (F.col("ss") - F.col("s") == before("ss") - before("s"))
    )
    numbered = parts.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    return numbered.groupBy("d", "f", "run").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.min("sd").alias("sd"), F.min("sf").alias("sf"), F.min("ss").alias("ss")
    )


def _lists(spans: DataFrame, name: str) -> DataFrame:
    return spans.groupBy("d", "f").agg(F.collect_list(F.struct(*[c for c in spans.columns if c not in ("d", "f")])).alias(name))


def _with_spans(texts: DataFrame, spans: DataFrame, name: str, *more: DataFrame) -> DataFrame:
    """The texts with their spans as a list and, as ``asked``, the places in them that spans are said to come from."""
    asked = spans.select(F.col("sd").alias("d"), F.col("sf").alias("f"), F.col("ss").alias("s"), (F.col("ss") + F.col("e") - F.col("s")).alias("e"))
    lists = _lists(spans, name).join(_lists(asked.distinct(), "asked"), ["d", "f"], "full")
    for one in more:
        lists = lists.join(one, ["d", "f"], "full")
    return texts.join(lists, ["d", "f"], "left")


def _digests(k: int):
    """(sd, sf, ss, n, digest of n edges' words, d, f, s): of spans with their source, and of the sources themselves."""
    names = ["sd", "sf", "ss", "n", "digest", "d", "f", "s"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, size in slices(batch.column(2)):
                part = batch.slice(lo, size)
                out: list[tuple] = []
                for d, f, text, spans, asked in zip(*(as_bytes(c) if i == 2 else c.to_pylist() for i, c in enumerate(part.columns))):
                    words, known = (text or b"").split(), {}
                    places = [(o["s"], o["e"], o["sd"], o["sf"], o["ss"]) for o in spans or ()]
                    places += [(o["s"], o["e"], d, f, o["s"]) for o in asked or ()]
                    for first, end, *source in places:
                        if (first, end) not in known:
                            joined = b" ".join(words[first : end + k - 1])
                            known[first, end] = hashlib.blake2b(joined, digest_size=16).digest()
                        out.append((*source, end - first, known[first, end], d, f, first))
                kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3
                columns = list(zip(*out)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)

    return work


def _disproved(texts: DataFrame, name: str, k: int) -> DataFrame:
    """(d, f, s, e) of the spans whose words are not those of their source; stored.

    The digests of a source and of all spans that name it meet in one aggregation, which combines equal ones before
    the shuffle. Spans are looked at one by one only where some differ.
    """
    places = texts.filter(f"{name} IS NOT NULL OR asked IS NOT NULL").select("d", "f", "text", name, "asked")
    schema = "sd long, sf long, ss long, n long, digest binary, d long, f long, s long"
    found, key = stored(places.mapInArrow(released(_digests(k)), schema), "digests"), ["sd", "sf", "ss", "n"]
    mixed = found.groupBy(*key).agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi")
    mixed = stored(mixed.select(*key), "mixed")
    own = found.filter("d = sd AND f = sf AND s = ss").select(*key, F.col("digest").alias("told"))
    told = found.join(mixed, key).join(own, key).filter("digest <> told")
    return stored(told.select("d", "f", "s", (F.col("s") + F.col("n")).alias("e")).distinct(), "disproved")


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``rest`` (all columns but the text, as a struct), ``text`` and the key (d, f) of each row."""
    body = named(text).cast("string")
    others = [named(c) for c in docs.columns if c != text] or [F.lit(None).alias("none")]
    return docs.select(
        F.struct(*others).alias("rest"),
        body.alias("text"),
        F.coalesce(named("doc_id").cast("long"), F.lit(NO_ID)).alias("d"),
        fingerprint(body).alias("f"),
    )


def _spans(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Keyed documents with their repeats and edges to open, the verified paths; the same of opened edges."""
    ship(docs.sparkSession)
    if not ANCHOR <= k <= ANCHOR + 14:
        raise ValueError(f"k is {ANCHOR} to {ANCHOR + 14} words")
    rows = keyed(docs)
    edges = rows.select("d", "f", "text").mapInArrow(released(lambda b: _edge_rows(_from_texts(b, k))), EDGE)
    found = stored(_compared(edges), "edges")
    paths = stored(_paths(found.filter("kind = 0")), "paths")
    opened = found.filter("kind = 1").select("d", "f", _first("p").alias("s"), (_first("p") + _count("p")).alias("e"))
    whole = stored(_with_spans(rows, paths, "repeats", _lists(opened.distinct(), "opened")), "texts")
    whole, paths = _verified(whole, paths, "repeats", k)
    checks = whole.filter("opened IS NOT NULL")
    single = checks.select("d", "f", "text", "opened").mapInArrow(released(lambda b: _edge_rows(_from_checks(b, k))), EDGE)
    more = stored(_paths(_compared(single).filter("kind = 0")), "opened-paths")
    checked = stored(_with_spans(checks.drop("asked"), more, "more"), "opened-texts")
    checked, more = _verified(checked, more, "more", k)
    return whole, paths, checked, more


def _verified(texts: DataFrame, spans: DataFrame, name: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Both without the spans whose words are not those of their source."""
    wrong = _disproved(texts, name, k)
    if wrong.isEmpty():
        return texts, spans
    spans = stored(spans.join(wrong, ["d", "f", "s", "e"], "left_anti"), "paths")
    return texts.drop(name).join(_lists(spans, name), ["d", "f"], "left"), spans


def repeated_spans(docs: DataFrame, k: int = K) -> DataFrame:
    """Words ``first`` to ``last`` (exclusive) of a document that occur earlier, from word ``source_first`` of document
    ``source_id`` on. Spans of one document may overlap, as may those of neighbouring paths."""
    _, paths, _, more = _spans(docs, k)
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return paths.unionByName(more).select(
        known("d").alias("doc_id"),
        "f",
        F.col("s").alias("first"),
        (F.col("e") + (k - 1)).alias("last"),
        known("sd").alias("source_id"),
        F.col("sf").alias("source_f"),
        F.col("ss").alias("source_first"),
    )


def _kept(k: int, as_is: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                part = batch.slice(lo, n)
                texts = as_bytes(part.column(1))
                counts, gone, left = [], [], []
                lists = [part.column(i).to_pylist() for i in range(2, part.num_columns)]
                for text, *spans in zip(texts, *lists):
                    words = (text or b"").split()
                    keep = np.ones(len(words), bool)
                    for span in (s for some in spans for s in some or ()):
                        keep[span["s"] : span["e"] + k - 1] = False
                    counts.append(len(words))
                    gone.append(len(words) - int(keep.sum()))
                    if gone[-1] or not as_is:
                        text = b" ".join([words[i] for i in np.flatnonzero(keep).tolist()] if gone[-1] else words)
                    left.append(text or b"")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())],
                    ["rest", "n_words", "n_removed", "kept"],
                )

    return work


def remove_repeats(docs: DataFrame, k: int = K, as_is: bool = False) -> DataFrame:
    """``rest`` (the other columns as a struct), ``n_words``, ``n_removed`` and ``kept``, the words left, joined by a space.

    ``as_is``: a text that loses nothing stays as it is, white space included.
    """
    whole, _, checked, _ = _spans(docs, k)
    kept = lambda df: df.mapInArrow(released(_kept(k, as_is)), _schema(whole))
    plain = whole.filter("opened IS NULL").select("rest", "text", "repeats")
    return kept(plain).unionByName(kept(checked.select("rest", "text", "repeats", "more")))


def _schema(whole: DataFrame):
    from pyspark.sql import types as T

    more = T.StructType.fromDDL("n_words long, n_removed long, kept string")
    return T.StructType([whole.schema["rest"], *more.fields])


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select(
        "rest.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
windows AS (
  SELECT doc_id, p, count(*) OVER later AS n, md5(string_agg(word, ' ') OVER later) AS phrase FROM words
  WINDOW later AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), repeated AS (
  SELECT doc_id, p FROM windows WHERE n = 20
  QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY doc_id, p) > 1
), removed AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM repeated),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN removed USING (doc_id, p) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the word sequences that occur earlier; one of which nothing is left goes.

    The text of a shortened document is its kept words, joined by a space; all others stay as they are.
    """
    cleaned = remove_repeats(docs, as_is=True).filter("kept <> ''")
    columns: Sequence[Column] = [
        F.col("kept").alias(c)
        if c == "text"
        else F.length("kept").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars"
        else F.col("rest")[c].alias(c)
        for c in docs.columns
    ]
    return cleaned.select(*columns)
