"""Benchmark decontamination (operator 5): a positional inverted index of the training texts.

The index is a stored table of postings (document, position, term) for the terms that the test items use, one list for
each different text of an id. Items become windows of ten consecutive words. For each window the postings of its rarest terms
are shifted by the term's place in the window and intersected, cell by cell: where shifted positions of all of them fall in one
cell, or its neighbour, the window may start. What survives is compared with the text's words at each position of the rarest
term. An exact phrase match has all words in place; a proximity match has each word within ``SLOP`` places of where the
rarest one says it should be. DataFrame functions only: no Python runs on executors.

Rarity is counted over all documents. No list is cut: a window of common words has long lists, which stay
spread over the tasks as they lie. A small side is broadcast only after its rows have been counted; beyond the bound
the join shuffles.

Cases: a null or empty text has no words and no hits; a text of any length is indexed whole. An item without words has no
windows; an item of fewer than ten words is one window. Items without id mark words but are not listed. Equal rows are indexed
and compared once and judged alike, repeated windows are searched once. Of equally rare terms of a window the first is
taken. Empty tables give no hits. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import bounded, documents, named, stored

# The words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text whose A-Z are lower-cased: before that, capital letters belong to
# them as well. Written as what is in the class, which Java matches many times faster than its complement.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
LISTS = 2  # lists that are intersected before texts are compared
SLOP = 2  # places that a word of a proximity match may be away from its own
CELL = 16  # positions of a cell in which shifted lists meet
BROADCAST_ROWS = 200_000  # rows of a side that may be broadcast, a few MB
NO_ID = -(1 << 63)


def lowered(word: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, LOWER)
    )


def words(text: Column | str) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lowered_words(text: str) -> Column:
    return words(F.translate(F.col(text), UPPER, LOWER))


def small(df: DataFrame) -> DataFrame:
    return bounded(df, BROADCAST_ROWS)


def keyed(docs: DataFrame) -> DataFrame:
    """d (id), h (hash of the text) and text. Both keys together name a row."""
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64(text).alias("h"), text.alias("text")
    )


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row of each (d, h). Only rows whose key occurs again are shuffled, and combined before that."""
    rows = keyed(docs)
    again = rows.select("d", "h").groupBy("d", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("d", "h")
    again = stored(again, "repeated-rows")
    if again.isEmpty():
        return rows
    few = small(again)
    one = rows.join(few, ["d", "h"], "left_semi").groupBy("d", "h").agg(F.first("text").alias("text"))
    return rows.join(few, ["d", "h"], "left_anti").unionByName(one)


def windows_of(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(wid, terms) of the distinct windows of all items, numbered, and (wid, item_id) of the items that have them."""
    found = items.select("item_id", lowered_words("text").alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    cut = found.select("item_id", "w", F.explode(starts).alias("i"))
    cut = cut.select("item_id", F.slice("w", F.col("i") + 1, F.lit(size)).alias("terms"))
    has = stored(cut.distinct(), "windows-of-items")
    windows = stored(has.select("terms").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    return windows.select("wid", "terms"), has.join(windows, "terms").select("wid", "item_id")


def build_index(texts: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored postings (d, h, pos, term) of the texts (d, h, text) for the windows' terms, and (term, word, df).

    One pass over the texts; each term is a number. df counts all postings of the term.
    """
    distinct = windows.select(F.explode("terms").alias("word")).distinct()
    vocabulary = stored(distinct.withColumn("term", F.monotonically_increasing_id()), "terms")
    each = texts.select("d", "h", F.posexplode(words("text")).alias("pos", "raw"))
    each = each.select("d", "h", "pos", lowered(F.col("raw")).alias("word"))
    postings = stored(each.join(small(vocabulary), "word").select("d", "h", "pos", "term"), "postings")
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return postings, stored(vocabulary.join(df, "term"), "term-counts")


def ranked(windows: DataFrame, terms: DataFrame) -> DataFrame:
    """(wid, len, at, term, rank) of the windows all of whose terms occur; rank 1 is the rarest place."""
    places = windows.select("wid", F.size("terms").alias("len"), F.posexplode("terms").alias("at", "word"))
    per = Window.partitionBy("wid")
    found = places.join(terms, "word").withColumn("found", F.count(F.lit(1)).over(per))
    order = per.orderBy("df", "at")
    whole = found.filter("found = len").withColumn("rank", F.row_number().over(order))
    return stored(whole.select("wid", "len", "at", "term", "rank"), "places")


def candidates(postings: DataFrame, places: DataFrame, lists: int = LISTS, slop: int = SLOP) -> DataFrame:
    """(d, h, wid, len, starts): where the rarest term of a window has positions that put the window's start in a cell in which
    the shifted lists of its ``lists`` rarest terms meet.

    Every start that has all of these terms within ``slop`` of their places is among them.
    """
    rare = stored(places.filter(F.col("rank") <= lists), "rare")
    shifted = postings.join(small(rare), "term").select(
        "d", "h", "wid", "len", "rank", (F.col("pos") - F.col("at")).alias("start"), F.least("len", F.lit(lists)).alias("need")
    )
    # The rarest term's start belongs to the cells that a start within slop of it can be in: mostly one, at most two.
    first = F.col("rank") == 1
    cells = lambda *by: F.array_distinct(F.array(*[F.floor((F.col("start") + i) / CELL) for i in by]))
    cell = F.explode(F.when(first, cells(-slop, slop)).otherwise(cells(0)))
    met = shifted.select("d", "h", "wid", "len", "need", "rank", "start", cell.alias("cell"))
    both = met.groupBy("d", "h", "wid", "len", "need", "cell").agg(
        F.bit_count(F.bit_or(F.expr("shiftleft(1, rank)"))).alias("n"),
        F.collect_set(F.when(first, F.col("start"))).alias("starts"),
    )
    return both.filter("n = need").select("d", "h", "wid", "len", "starts")


def matches(texts: DataFrame, found: DataFrame, windows: DataFrame, slop: int = SLOP) -> DataFrame:
    """(d, h, wid, start, len, exact) of the windows at starts of candidates that the text's words bear out; stored.

    Only texts with candidates take part. Their words are cut once and met by the list of the text's candidates, and each
    candidate goes on with the few words around it. What is broadcast is bounded by counts of rows of a few numbers, or of windows.
    """
    each = stored(found.select("d", "h", "wid", "len", F.explode("starts").alias("start")).distinct(), "candidates")
    lists = each.groupBy("d", "h").agg(F.collect_list(F.struct("wid", "len", "start")).alias("asked"))
    lists = stored(lists, "candidate-lists")
    few = texts.join(small(lists.select("d", "h")), ["d", "h"], "left_semi")
    if each.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        lists = F.broadcast(lists)
    words_of = few.join(lists, ["d", "h"]).select("d", "h", lowered_words("text").alias("w"), "asked")

    def around(c: Column) -> Column:
        """The words from ``slop`` before the window's place to ``slop`` behind it, and how many of them come before."""
        first = F.greatest(c["start"] - slop, F.lit(0))
        n = F.greatest(c["start"] + c["len"] + slop - first, F.lit(0))
        near = F.slice("w", (first + 1).cast("int"), n.cast("int"))
        return F.struct(c["wid"].alias("wid"), c["start"].alias("start"), (c["start"] - first).alias("before"), near.alias("near"))

    met = words_of.select("d", "h", F.inline(F.transform("asked", around))).join(small(stored(windows, "searched")), "wid")

    def at(i: Column, out: int) -> Column:
        return F.col("before") + i + 1 + out

    def has(term: Column, i: Column) -> Column:
        first = F.greatest(at(i, -slop), F.lit(1))
        return F.array_contains(F.slice("near", first.cast("int"), F.greatest(at(i, slop) - first + 1, F.lit(0)).cast("int")), term)

    same = F.when(F.col("before") >= 0, F.slice("near", (F.greatest("before", F.lit(0)) + 1).cast("int"), F.size("terms")) == F.col("terms"))
    exact = F.coalesce(same, F.lit(False))
    near = F.forall(F.transform("terms", has), lambda x: x)
    borne = met.select("d", "h", "wid", "start", F.size("terms").alias("len"), exact.alias("exact"), near.alias("near"))
    return stored(borne.filter("exact OR near").drop("near"), "matches")


def hits(found: DataFrame, owners: DataFrame) -> DataFrame:
    """(d, h, n_hit, items, near_items) of the documents with matches: words in any exact match, the items that have one, and the
    items that have proximity matches alone."""
    exact = found.filter("exact")
    order = Window.partitionBy("d", "h").orderBy("start", "len")
    end = F.col("start") + F.col("len")
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(end - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
    spans = exact.select("d", "h", "start", "len").distinct()
    counts = spans.withColumn("new", new).groupBy("d", "h").agg(F.sum("new").cast("long").alias("n_hit"))
    of_items = found.select("d", "h", "wid", "exact").distinct().join(small(stored(owners, "owners")), "wid")
    each = of_items.groupBy("d", "h", F.col("item_id").cast("string").alias("item")).agg(F.max("exact").alias("exact"))
    listed = each.groupBy("d", "h").agg(
        F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"),
        F.array_sort(F.collect_list(F.when(~F.col("exact"), F.col("item")))).alias("near_items"),
    )
    return listed.join(counts, ["d", "h"], "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """(d, h, n_hit, items, near_items) of each text with exact or proximity matches; contaminated where ``n_hit`` is not 0."""
    windows, owners = windows_of(items, size)
    texts = distinct_texts(docs)
    postings, terms = build_index(texts, windows)
    found = candidates(postings, ranked(windows, terms), slop=slop)
    return hits(matches(texts, found, windows, slop), owners)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = stored(decontaminated(docs, documents(spark, sf_dir, "benchmark")), "contaminated")
    text = F.col("text").cast("string")
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(text).alias("h"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
    )
    items, near = (F.coalesce(c, F.array().cast("array<string>")) for c in ("items", "near_items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, ["d", "h"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size(near).cast("long").alias("n_near_items"),
        F.array_join(near, ",").alias("near_items"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), lens AS (SELECT DISTINCT least(len(w), 10) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
), hit AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, phrase)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY 1),
-- Proximity: each word of a window within two places of where the window's rarest word puts it.
postings AS (SELECT doc_id, w, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
df AS (SELECT word, count(*) AS n FROM postings GROUP BY 1),
shapes AS (SELECT DISTINCT phrase, string_split(phrase, ' ') AS terms FROM windows),
places AS (SELECT phrase, terms, unnest(terms) AS word, generate_subscripts(terms, 1) AS place FROM shapes),
rarest AS (
  SELECT phrase, any_value(terms) AS terms, arg_min(word, (df.n, place)) AS word, arg_min(place, (df.n, place)) AS place
  FROM places LEFT JOIN df USING (word) GROUP BY 1 HAVING count(df.n) = count(*)
), anchored AS (SELECT doc_id, w, phrase, terms, p - place AS start FROM rarest JOIN postings USING (word)),
near AS (
  SELECT DISTINCT doc_id, phrase FROM anchored
  WHERE list_bool_and(list_transform(range(1, len(terms) + 1), lambda i: start + i + 2 >= 1
    AND list_contains(w[greatest(start + i - 2, 1):start + i + 2], terms[i])))
), near_items AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS found
  FROM near JOIN (SELECT DISTINCT item_id, phrase FROM windows) USING (phrase) GROUP BY 1
), joined AS (
  SELECT d.doc_id, w, n_hit, coalesce(items, []) AS items,
    list_filter(coalesce(found, []), lambda x: NOT list_contains(coalesce(items, []), x)) AS others
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near_items USING (doc_id)
)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(len(items) AS BIGINT) AS n_items, sha256(array_to_string(items, ',')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(len(others) AS BIGINT) AS n_near_items, array_to_string(others, ',') AS near_items
FROM joined
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any benchmark window."""
    found = decontaminated(docs, documents(spark, sf_dir, "benchmark")).filter("n_hit > 0")
    found = stored(found.select("d", "h"), "contaminated")
    rows = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(docs["text"].cast("string")).alias("h"),
    )
    return rows.join(small(found), ["d", "h"], "left_anti").select("row.*")
