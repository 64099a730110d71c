"""MinHash near-dedup (operator 6): fast similarity sketches, banding and exact verification.

A text's set is its distinct shingles of five words (A-Z lower-cased). Its sketch has ``t`` coordinates. In round i
every shingle is hashed to one coordinate (in the last t rounds to coordinate i - t) with a value from [i, i + 1), and
each coordinate keeps its smallest value; rounds stop when all are filled, after 2t at the latest. So
every coordinate of every set is filled, and agreeing coordinates estimate the similarity with the concentration of
independent ones. Groups of ``rows`` coordinates make a band; sets that share a band are candidates.

Texts with equal sets are one class. In each bucket, classes are compared with one pivot (a star, not all pairs),
on their full sets. Buckets whose classes are by then in one component are done. In the others, only pairs of different components
are compared that can be similar at all, by two exact bounds: their distances to the common pivot differ by no more than the
threshold allows (the Jaccard distance is a metric), and enough of their shingles occur in any other class.
Pairs inside a component change nothing and are never listed. Components come from hooking and pointer
jumping on stored tables.

Cases: texts without words have an empty set and are linked with nothing. Rows of one id are judged by their own text;
copies of a row share its result. A null id is never the name of a component unless all its ids are null. A text of any
length has one sketch and one full set. Of equally central classes of a bucket the one with the largest hash is the pivot,
which changes no component; a component is named after its smallest id. An empty table gives no rows. Other columns are
carried along, whatever their names.
Missing a pair of similarity 0.75 in all bands has a probability of 3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import as_bytes, bounded, documents, named, released, ship, slices, stored
from lakestrata.llm.words import Words, mix

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 4
FEW_KEYS = 200_000  # buckets or components of which a row each may be broadcast
SKETCH = "n_shingles long, node binary, bands array<bigint>"
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 40) - 1)


def shingle_sets(texts: list[bytes | None], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, in order of text. A text of fewer words is one shingle."""
    words = Words([t and t.lower() for t in texts])
    hashes = words.hashes()
    at, grams = words.windows(hashes, k)
    owner = words.owner[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        whole = [np.sum(mix(hashes[words.first[i] : words.first[i + 1]] + np.arange(words.counts[i], dtype=np.uint64))) for i in short]
        owner = np.concatenate([owner, short])
        grams = np.concatenate([grams, mix(np.array(whole, np.uint64))])
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
    return owner[new], grams[new]


def sketches(owner: np.ndarray, grams: np.ndarray, n: int, t: int) -> np.ndarray:
    """The n x t coordinates. Sets without shingles keep the largest value everywhere."""
    out = np.full(n * t, _FULL, np.uint64)
    seeds = mix(np.arange(1, 2 * t + 1, dtype=np.uint64))
    for i in range(2 * t):
        if not len(owner):
            break
        x = mix(grams + seeds[i])
        place = ((x >> np.uint64(40)) * np.uint64(t) >> np.uint64(24)).astype(np.int64) if i < t else np.full(len(owner), i - t)
        np.minimum.at(out, owner * t + place, np.uint64(i) << np.uint64(40) | (x & _LOW))
        open_ = (out.reshape(n, t) == _FULL).any(axis=1)[owner]
        owner, grams = owner[open_], grams[open_]
    return out.reshape(n, t)


def _sketcher(bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            for lo, n in slices(batch.column(2)):
                part = batch.slice(lo, n)
                owner, grams = shingle_sets(as_bytes(part.column(2)))
                table = sketches(owner, grams, n, bands * rows).reshape(n, bands, rows)
                keys = np.broadcast_to(salt, (n, bands)).copy()
                for r in range(rows):
                    keys = mix(keys ^ table[:, :, r]) + np.uint64(r)
                sizes = np.bincount(owner, minlength=n)
                sums = np.zeros((n, 2), np.uint64)
                for i in range(2):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams + np.uint64(i)))])
                    ends = np.cumsum(sizes)
                    sums[:, i] = total[ends] - total[ends - sizes]
                bounds = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(sizes, pa.int64()),
                        pa.array([s.tobytes() if c else None for s, c in zip(sums, sizes)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys[sizes > 0].ravel().view(np.int64))),
                    ],
                    ["doc_id", "f", "n_shingles", "node", "bands"],
                )

    return work


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, f (fingerprint of the text), n_shingles, node (128-bit hash of the set; null if empty) and band keys."""
    ship(docs.sparkSession)
    rows_ = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("f"),
        F.col("text").cast("string").alias("text"),
    )
    return rows_.mapInArrow(released(_sketcher(bands, rows)), f"doc_id long, f long, {SKETCH}")


def _verifier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the common part and of the union of each pair's full sets."""
    for batch in batches:
        for lo, n in slices(batch.column(2), 1 << 19):
            part = batch.slice(lo, n)
            one, a = shingle_sets(as_bytes(part.column(2)))
            two, b = shingle_sets(as_bytes(part.column(3)))
            owner, grams = np.concatenate([one, two]), np.concatenate([a, b])
            order = np.lexsort((grams, owner))
            owner, grams = owner[order], grams[order]
            both = owner[1:][(owner[1:] == owner[:-1]) & (grams[1:] == grams[:-1])]
            common = np.bincount(both, minlength=n)
            union = np.bincount(owner, minlength=n) - common
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(common, pa.int64()), pa.array(union, pa.int64())],
                ["a", "b", "common", "total"],
            )


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes with the size of the common part of their sets and of their union."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("two"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "one", "two")
    return both.mapInArrow(released(_verifier), "a binary, b binary, common long, total long")


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) after joining the components that links (a, b) connect; comp is the smallest node.

    Each component hooks on to its smallest neighbour, then pointers jump until all name a root: the links a round has used
    are gone afterwards, so no label may stop half way. Components shrink until no link joins two of them. Every round
    and every jump is stored.
    """
    while True:
        one = labels.withColumnsRenamed({"node": "a", "comp": "ca"})
        two = labels.withColumnsRenamed({"node": "b", "comp": "cb"})
        links = links.join(one, "a").join(two, "b").filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        links = stored(links.distinct(), "links")
        if links.isEmpty():
            return labels
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        jumped = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")), "hooks")
        moved = True
        while moved:
            above = jumped.select(F.col("a").alias("up"), F.col("up").alias("top"))
            found = stored(jumped.join(above, "up").select("a", F.col("top").alias("up"), (F.col("top") < F.col("up")).alias("moved")), "hooks")
            jumped, moved = found.select("a", "up"), not found.filter("moved").isEmpty()
        names = jumped.withColumnsRenamed({"a": "comp"})
        labels = stored(
            labels.join(names, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "labels"
        )
        # Links are between components now: each is a node of its own.
        links = links.join(jumped, "a").select(F.col("up").alias("a"), "b")
        links = links.join(jumped.withColumnRenamed("a", "b").withColumnRenamed("up", "ub"), "b").select("a", F.col("ub").alias("b"))
        links = links.filter("a <> b")


def _texts(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, text) of one document of each class that shares a bucket with another class."""
    keys = members.select("node").distinct().join(classes, "node")
    keys = keys.select("node", F.col("row.doc_id").alias("rd"), F.col("row.f").alias("rf"))
    bodies = _keyed(docs)
    match = bodies["doc_id"].eqNullSafe(keys["rd"]) & bodies["f"].eqNullSafe(keys["rf"])
    return stored(bodies.join(keys, match).select("node", "text").dropDuplicates(["node"]), "texts")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("f"), text.alias("text"))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, n in slices(batch.column(1)):
            owner, grams = shingle_sets(as_bytes(batch.column(1).slice(lo, n)))
            nodes = batch.column(0).slice(lo, n).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([nodes, pa.array(grams.view(np.int64))], ["node", "gram"])


def shared_sizes(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, alone): how many shingles of each of these classes no other of them has; classes without any are left out."""
    grams = texts.join(nodes, "node", "left_semi").select("node", "text").mapInArrow(released(_grams), "node binary, gram long")
    once = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).filter("n = 1")
    return once.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))


def unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their component, of the buckets that more than one component shares."""
    now = members.join(labels, "node")
    mixed = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    return stored(now.join(bounded(stored(mixed, "mixed"), FEW_KEYS), "key"), "left")


def linked(members: DataFrame, texts: DataFrame, percent: int = PERCENT, stars: int = 1) -> DataFrame:
    """(node, comp) of all classes that share a bucket: the components of the links of at least ``percent``.

    Each bucket is compared with its most central class, then ``stars`` times with one more; what pairs remain between
    components, and can be similar enough at all, are then listed.
    """
    gap = 1 - percent / 100 + 1e-9
    links = lambda pairs: pairs.filter(F.col("common") * 100 >= F.col("total") * percent).select("a", "b")
    # The class that meets the most others is the most central one: the original that copies were made from, if it is there.
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    members = stored(members.join(weight, "node").select("key", "node", "n", "weight"), "weighted")
    pivots = members.groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("pivot"))
    members = members.join(pivots, "key")
    pairs = members.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    found = stored(verified(pairs, texts), "verified")
    labels = stored(members.select("node").distinct().withColumn("comp", F.col("node")), "labels")
    labels = components(labels, links(found))
    # Every class of a bucket now has its distance to the pivot; the pivot itself has met all others.
    met = found.select(
        F.col("a").alias("node"), F.col("b").alias("pivot"), "common", (1 - F.col("common") / F.col("total")).alias("far")
    )
    # From here on a pivot's buckets are one: a pair that shares several of them is met once, and no pair is lost.
    around = members.select("node", "n", "weight", "pivot").distinct().join(met, ["node", "pivot"])
    left = unresolved(around.withColumn("key", F.col("pivot")), labels)
    if left.isEmpty():
        return labels
    # What two classes have in common is either in the pivot too, or outside it and in both: at most the smaller of what
    # each has in common with the pivot and the smaller of what each has outside it that any other class has as well.
    asked = left.select("node").unionByName(left.select(F.col("pivot").alias("node"))).distinct()
    alone = stored(shared_sizes(asked, texts), "alone")
    left = left.join(alone, "node", "left").withColumn("outside", F.col("n") - F.col("common") - F.coalesce("alone", F.lit(0)))
    able = (F.col("common") + F.col("outside")) * 100 >= F.col("n") * percent
    left = stored(left.filter(able).select("key", "node", "n", "weight", "far", "common", "outside"), "left")
    for round_ in range(stars + 1):
        left = unresolved(left, labels)
        if left.isEmpty():
            break
        columns = ["n", "common", "outside", "far", "comp"]
        x = left.select("key", F.col("node").alias("a"), *[F.col(c).alias(f"{c}a") for c in columns])
        y = left.select("key", "weight", F.col("node").alias("b"), *[F.col(c).alias(f"{c}b") for c in columns])
        if round_ < stars:
            top = F.max(F.struct("weight", "b", *[f"{c}b" for c in columns])).alias("y")
            # One row for each bucket: stored, so that the members of a hot bucket are met where they lie, or at least can be
            # split among tasks.
            y = bounded(stored(y.groupBy("key").agg(top).select("key", "y.*"), "stars"), FEW_KEYS)
        most = F.least("commona", "commonb") + F.least("outsidea", "outsideb")
        able = (
            (F.col("compa") != F.col("compb"))
            & (F.abs(F.col("fara") - F.col("farb")) <= gap)
            & (most * 100 >= (F.col("na") + F.col("nb") - most) * percent)
        )
        if round_ == stars:
            able = able & (F.col("a") < F.col("b"))
        pairs = stored(x.join(y, "key").filter(able).select("a", "b").distinct(), "pairs")
        if round_ < stars:
            left = left.join(y.select("key", F.col("b").alias("node")), ["key", "node"], "left_anti")
        left = left.drop("comp")
        if not pairs.isEmpty():
            labels = components(labels, links(stored(verified(pairs, texts), "verified")))
    return labels


def near_groups(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """Of each row: doc_id, f (fingerprint of its text), n_shingles, component_id (the smallest id of its group) and
    ``chosen``, the (doc_id, f) of the row that stands for the group."""
    made = stored(sketch(docs, bands, rows), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "f")
    classes = stored(
        made.filter("n_shingles > 0")
        .groupBy("node")
        .agg(F.min(order).alias("row"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    one = classes.select("node", "n", F.explode("bands").alias("key"))
    shared = one.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(one.join(shared, "key"), "members")
    labels = linked(members, _texts(docs, classes, members), percent)
    grouped = labels.join(classes.select("node", "row"), "node")
    firsts = bounded(stored(grouped.groupBy("comp").agg(F.min("row").alias("top")), "firsts"), FEW_KEYS)
    tops = grouped.join(firsts, "comp").select("node", "top")
    names = classes.select("node", "row").join(tops, "node", "left").select("node", F.coalesce("top", "row").alias("top"))
    found = made.select("doc_id", "f", "n_shingles", "node").join(stored(names, "names"), "node", "left")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "f")
    return found.withColumn("top", F.coalesce("top", own)).select(
        "doc_id", "f", "n_shingles", F.col("top.doc_id").alias("component_id"), F.struct("top.doc_id", "top.f").alias("chosen")
    )


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(documents(spark, sf_dir))
    return groups.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), words AS (SELECT doc_id, len(w) AS n_words, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
windows AS (
  SELECT doc_id, n_words, count(*) OVER later AS n, md5(string_agg(word, ' ') OVER later) AS shingle FROM words
  WINDOW later AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
), sets AS (
  SELECT doc_id, list_sort(list(DISTINCT shingle)) AS shingles FROM windows WHERE n = least(n_words, 5) GROUP BY 1
), classes AS (  -- documents of one set are linked; further links are sought between different sets
  SELECT min(doc_id) AS id, shingles, len(shingles) AS n FROM sets GROUP BY shingles
), single AS (SELECT id, n, unnest(shingles) AS shingle FROM classes),
links AS (
  SELECT a.id AS a, b.id AS b FROM single a JOIN single b ON a.shingle = b.shingle AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(a, b) AS (SELECT id, id FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
components AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY 1),
found AS (
  SELECT doc_id, n, component_id FROM sets JOIN classes USING (shingles) JOIN components USING (id)
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM d LEFT JOIN found USING (doc_id)
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one of the smallest id; of rows with one id and text, one."""
    groups = near_groups(docs)
    stays = groups.filter(F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("f") == F.col("chosen.f")))
    keys = stays.select(F.col("doc_id").alias("kd"), F.col("f").alias("kf")).distinct()
    rows = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("d"),
        F.xxhash64(F.col("text").cast("string")).alias("f"),
    )
    kept = rows.join(keys, rows["d"].eqNullSafe(keys["kd"]) & rows["f"].eqNullSafe(keys["kf"]), "left_semi")
    return kept.dropDuplicates(["d", "f"]).select("row.*")
