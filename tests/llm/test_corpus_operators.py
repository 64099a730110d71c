"""Operators that compare documents with each other, and the pipeline, against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import decontaminate, near_dups, quality_rules, repeats
from lakestrata.llm.common import documents


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def plain_groups(rows):
    """Smallest id of each row's group; rows are told apart by id and text."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    sets, top = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {(d, t): (len(sets[i]), rows[find(i)][0]) for i, (d, t) in enumerate(rows)}


def near_copies(n, seed, few):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(250)]
    base = [[r.choice(words) for _ in range(k)] for k in (3, 6, 30, 80, 150)]
    rows = []
    for i in range(n):
        b = list(base[i % 5] if few else base[4])
        for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
            b[r.randrange(len(b))] = r.choice(words)
        if r.random() < 0.2:
            b += [r.choice(words) for _ in range(len(b) // 3)]
        rows.append((i, " ".join(b)))
    return rows


@pytest.mark.parametrize("few", [True, False])
def test_near_groups_equal_all_pairs(spark, few):
    rows = near_copies(240, 3, few)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.near_groups(docs).collect()}
    assert got == {d: v for (d, _), v in plain_groups(rows).items()}


def test_near_groups_of_awkward_texts(docs, texts):
    got = near_dups.near_groups(docs).collect()
    want = plain_groups([(d, t) for d, t, _ in texts])
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(
        ((d, *want[d, t]) for d, t, _ in texts), key=str
    )


def test_components_of_chains_in_every_order(spark):
    r = random.Random(5)
    chains = [list(c) for n in (4, 5) for c in itertools.permutations(range(n))]
    chains += [r.sample(range(n), n) for n in range(6, 21) for _ in range(30)]
    names = [[b"%04d-%02d" % (i, x) for x in chain] for i, chain in enumerate(chains)]
    labels = spark.createDataFrame([(x, x) for chain in names for x in chain], "node binary, comp binary")
    links = spark.createDataFrame([p for chain in names for p in zip(chain, chain[1:])], "a binary, b binary")
    got = {bytes(x.node): bytes(x.comp) for x in near_dups.components(labels, links).collect()}
    assert got == {x: min(chain) for chain in names for x in chain}


def test_every_coordinate_is_filled_and_agreement_estimates_similarity():
    r = np.random.default_rng(0)
    pool = r.integers(1, 2**63, 400, dtype=np.uint64)
    sets = [pool[:1], pool[:300], pool[100:400], pool[:0]]
    owner = np.repeat(np.arange(4), [len(s) for s in sets])
    table_ = near_dups.sketches(owner, np.concatenate(sets), 4, 512)
    assert (table_[:3] != near_dups._FULL).all() and (table_[3] == near_dups._FULL).all()
    assert abs((table_[1] == table_[2]).mean() - 0.5) < 0.08


def plain_kept(rows, k):
    """What is left of each (id, text), documents in order of id; copies of one row are one document."""
    seen, out = set(), {}
    for d, t in rows:
        words = (t or "").encode().split()
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - k + 1):
            gram = tuple(words[i : i + k])
            if gram in seen:
                gone[i : i + k] = True
            seen.add(gram)
        out[d, t] = (len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


@pytest.mark.parametrize("combined", [50, 1_000_000])
@pytest.mark.parametrize("words", [3, 400])
def test_repeats_equal_a_plain_search(spark, monkeypatch, combined, words):
    monkeypatch.setattr(repeats, "COMBINED", combined)
    r = random.Random(words)
    vocabulary = [f"w{i}" for i in range(words)]
    base = [[r.choice(vocabulary) for _ in range(r.randint(0, 150))] for _ in range(8)]
    rows = []
    for i in range(80):
        b = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            if b:
                b[r.randrange(len(b))] = r.choice(vocabulary)
        rows.append((7 * i - 100, "\n".join(b[i % 9 :] + r.choice(base)[:40])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(docs).select("rest.*", "n_words", "n_removed", "kept").collect()}
    assert got == {d: v for (d, _), v in plain_kept(rows, 20).items()}
    spans, split = repeats.repeated_spans(docs).collect(), {d: t.split() for d, t in rows}
    for x in spans:
        n = x["last"] - x["first"]
        assert split[x["doc_id"]][x["first"] : x["last"]] == split[x["source_id"]][x["source_first"] : x["source_first"] + n]
    assert spans


def test_texts_of_one_id_whose_hashes_are_alike(spark):
    """Two texts of one id whose hashes share their low 27 bits: the one that nothing repeats keeps its words."""
    found = spark.range(60_000).select(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(25)), lambda i: F.concat(F.lit("w"), "id", F.lit("x"), i))).alias("t"))
    key = F.xxhash64("t").bitwiseAND(F.lit((1 << 27) - 1))
    a, b = found.groupBy(key.alias("k")).agg(F.collect_list("t").alias("t")).filter("size(t) > 1").first()["t"][:2]
    docs = spark.createDataFrame([(1, a), (5, a), (5, b)], "doc_id long, text string")
    kept = {(r["rest"]["doc_id"], r["kept"]): r["n_removed"] for r in repeats.remove_repeats(docs).collect()}
    assert kept == {(1, a): 0, (5, ""): 25, (5, b): 0}


def test_spans_of_other_words_are_dropped(spark):
    """As after a collision of both hashes: the third document is said to repeat the first, but has other words."""
    words = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(30))
    rows = repeats.keyed(spark.createDataFrame([(1, words), (2, words), (3, other)], "doc_id long, text string"))
    f = {r["d"]: r["f"] for r in rows.collect()}
    spans = [(2, f[2], 0, 11, 1, f[1], 0), (3, f[3], 2, 8, 1, f[1], 2)]
    spans = spark.createDataFrame(spans, "d long, f long, s long, e long, sd long, sf long, ss long")
    texts, left = repeats._verified(repeats.stored(repeats._with_spans(rows, spans, "repeats"), "texts"), spans, "repeats", 20)
    assert [r["d"] for r in left.collect()] == [2]
    assert {r["d"]: r["repeats"] is not None for r in texts.collect()} == {1: False, 2: True, 3: False}


def test_repeats_of_awkward_texts(docs, texts):
    got = repeats.remove_repeats(docs).select("rest.doc_id", "n_words", "n_removed", "kept").collect()
    assert len(got) == len(texts)
    # Two texts of one id come in either order; all others have one.
    rows = [(d, t) for d, t, _ in texts]
    orders = [sorted(dict.fromkeys(rows), key=lambda r, s=s: (r[0] is not None, r[0] or 0, s * len(r[1] or ""))) for s in (1, -1)]
    wants = [plain_kept(o, 20) for o in orders]
    found = sorted((tuple(r) for r in got), key=str)
    assert found in [sorted(((d, *w[d, t]) for d, t in rows), key=str) for w in wants]


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_hits(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for d, text in rows:
        w, hit, found = words_of(text), set(), set()
        for i in range(len(w)):
            for n in {len(x) for x in windows}:
                if tuple(w[i : i + n]) in windows and i + n <= len(w):
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((d, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


ITEMS = [(1, "the TENTH, word-for word ÉÈ passage that\nis long: longer than 10 words"), (2, None), (3, ""), (4, "two words"), (4, "two words"),
         (None, "no id here"), (10, "is long longer than 10 words and more of it to fill")]


@pytest.fixture(scope="module")
def leaky(spark):
    r = random.Random(4)
    rows = [(1, None), (2, ""), (None, "TWO words, no id here"), (5, "two words two words"), (5, "two words two words"), (5, "other text")]
    for i in range(20, 60):
        parts = [r.choice(["filler", "two", "words", "long", "the"]) for _ in range(30)]
        item = r.choice([t for _, t in ITEMS if t]).split()
        at = r.randrange(30)
        rows.append((i, " ".join(parts[:at] + item[: r.randint(1, len(item))] + parts[at:])))
    return rows


def test_decontamination_equals_a_plain_search(spark, leaky):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in leaky], "doc_id long, text string, h int, term string").repartition(3)
    items = spark.createDataFrame([(i, t, 2) for i, t in ITEMS], "item_id long, text string, wid int")
    found = {(r.d, r.h): r for r in decontaminate.decontaminated(docs, items).collect()}
    keys = decontaminate.keyed(docs).collect()
    for (d, n, n_hit, listed), (_, text) in zip(plain_hits(leaky, ITEMS), leaky):
        h = next(r.h for r in keys if r.text == text)
        r = found.get((decontaminate.NO_ID if d is None else d, h))
        assert (r.n_hit if r else 0, r["items"] if r else []) == (n_hit, listed), text
    assert decontaminate.decontaminated(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminated(docs, items.limit(0)).count() == 0


def test_decontamination_without_broadcasts(spark, leaky, monkeypatch):
    docs = spark.createDataFrame(leaky, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = {tuple(map(str, r)) for r in decontaminate.decontaminated(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "small", lambda df, rows=0: df)
    assert {tuple(map(str, r)) for r in decontaminate.decontaminated(docs, items).collect()} == want


def test_decontamination_runs_no_python(spark, capsys):
    decontaminate.op5_decontamination(spark, "/root/testdata/sf0.001").explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_proximity_allows_displaced_words(spark):
    docs = spark.createDataFrame([(1, "a alpha beta gamma"), (2, "alpha x beta gamma"), (3, "beta alpha"), (4, "gamma"), (5, "beta gamma alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    for slop, near in ((0, set()), (1, {2}), (2, {2}), (3, {2, 5})):
        found = {r.d: (r.n_hit, r["items"], r.near_items) for r in decontaminate.decontaminated(docs, items, slop=slop).collect()}
        assert found == {1: (3, ["1"], []), **{d: (0, [], ["1"]) for d in near}}


def test_equal_rows_are_indexed_and_compared_once(spark):
    leaked = "before " + " ".join(f"w{i}" for i in range(30)) + " after"
    docs = spark.createDataFrame([(1, leaked)] * 2000 + [(1, "another"), (2, leaked)], "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(20)))], "item_id long, text string")
    windows, _ = decontaminate.windows_of(items)
    postings, terms = decontaminate.build_index(decontaminate.distinct_texts(docs), windows)
    assert postings.count() == 2 * 20 and decontaminate.distinct_texts(docs).count() == 3
    found = decontaminate.candidates(postings, decontaminate.ranked(windows, terms))
    assert found.agg(F.sum(F.size("starts"))).first()[0] <= 2 * 2 * windows.count()
    assert {(r.d, r.n_hit, tuple(r["items"])) for r in decontaminate.decontaminated(docs, items).collect()} == {(1, 20, ("7",)), (2, 20, ("7",))}


def test_stages_one_by_one(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = documents(spark, sf_dir)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dups", "substring_dedup", "decontamination", "byte_bpe"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        if name == "byte_bpe":
            assert {r.doc_id for r in after.collect()} == set(rows)
            break
        assert after.columns == docs.columns
        got = {r.doc_id: r.text for r in after.collect()}
        if name == "quality_rules":
            rules = quality_rules.fit(docs, documents(spark, sf_dir, "labels"))
            kept = quality_rules.apply_rules(docs, rules, keep=["doc_id"]).filter("kept").select("row.doc_id")
            want = {r.doc_id: rows[r.doc_id] for r in kept.collect()}
        elif name == "near_dups":
            want = {d: t for (d, t), (_, top) in plain_groups(list(rows.items())).items() if d == top}
        elif name == "substring_dedup":
            plain = plain_kept(sorted(rows.items()), 20)
            want = {d: left if gone else t for (d, t), (_, gone, left) in plain.items() if left}
        else:
            items = [(r.item_id, r.text) for r in documents(spark, sf_dir, "benchmark").collect()]
            want = {d: rows[d] for d, _, hit, _ in plain_hits(rows.items(), items) if not hit}
        assert got == want, name
        docs, rows = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in got.items()], docs.schema), got


def test_stages_on_awkward_and_empty_tables(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0, name
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert name == "byte_bpe" or out.columns == docs.columns
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) <= docs.count()
        if name == "near_dups":
            assert ids.count(10) == 1  # one of three equal rows
        if name == "byte_bpe":
            assert len(ids) == docs.count()
