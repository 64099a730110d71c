"""Operators that work on one text at a time, against the libraries, plain Python or a round trip."""

import base64
import hashlib
import random
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import byte_bpe, html_text, language_id, lm_corpus, lm_score, quality_fm, quality_rules, token_store
from lakestrata.llm.common import documents, in_training_fold, labelled_sample
from lakestrata.session import scratch_path, shared_dir


def word_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_store.vocabulary_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_token_store_has_every_text_in_order_of_id(spark, docs, texts):
    path = token_store.write_store(docs, scratch_path(spark, "store"))
    got = token_store.read_store(spark, path).orderBy("start").collect()
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    ids = word_ids([t for _, t, _ in order])
    starts = np.cumsum([0, *map(len, ids)])[:-1].tolist()
    crcs = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == [
        (d, s, len(x), c) for (d, _, _), s, x, c in zip(order, starts, ids, crcs)
    ]
    one = token_store.read_ids(spark, path, 72).collect()
    assert [r.ids for r in one] == word_ids(["Ünïcode 😀 \x1c ABC"])


def test_token_store_encodes_markers_as_the_library_does(spark):
    rows = ["hello [UNK] a <|endoftext|> x", "a<|startoftext|>b", "<|ENDOFTEXT|> of", "plain", "<|endoftext|>" * 3, "<|endof text|>", None]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(2)
    path = token_store.write_store(docs, scratch_path(spark, "store"))
    got = {r.doc_id: r.ids for r in token_store.read_ids(spark, path).collect()}
    assert [got[i] for i in range(len(rows))] == word_ids(rows)
    assert 49407 in got[0] and 49406 in got[1]


def test_samples_by_hash_do_not_grow_with_the_tasks(spark):
    from lakestrata.llm.common import in_share

    df = spark.range(50_000).withColumn("h", F.xxhash64("id"))
    assert 700 < df.filter(in_share(F.col("h"), 1000, 50_000)).count() < 1300
    assert df.filter(in_share(F.col("h"), 60_000, 50_000)).count() == 50_000
    least = [r.id for r in df.orderBy("h").limit(200).collect()]
    assert [r.id for r in df.filter(in_share(F.col("h"), 800, 50_000)).orderBy("h").limit(200).collect()] == least


NAMES = ["a.b", "with`tick", "row", "ids", "key", "d", "h"]


def test_extra_columns_of_any_name_are_carried(spark):
    """Dots and backticks, and names that the operators use themselves."""
    body = " ".join(f"word{i}" for i in range(60)) + "."
    docs = spark.createDataFrame([(1, body, *NAMES), (2, body + " x", *NAMES), (3, None, *NAMES)], ["doc_id", "text", *NAMES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        for row in out.collect():
            assert tuple(row)[2:] == tuple(NAMES), name
    assert byte_bpe.stage(spark, docs.withColumns({"lang": F.lit("en"), "source": F.lit("s")}), "").count() == 3
    pages = docs.withColumnRenamed("text", "html")
    for made in (
        html_text.extract(pages), quality_rules.text_statistics(docs), byte_bpe.encode(docs), quality_fm.score(docs, quality_fm.fit(docs, docs.selectExpr("doc_id", "1 AS quality"))),
        language_id.predict(docs, language_id.fit(docs.withColumn("lang", F.lit("en")))),
        lm_score.score(docs, lm_score.fit(docs.selectExpr("text", "true AS target"))),
    ):
        assert made.count() == 3 and "with`tick" in made.select("row.*").columns


def test_token_store_refuses_another_dictionary(spark, docs):
    path = token_store.write_store(docs.filter("doc_id < 20"), scratch_path(spark, "store"))
    other = token_store.write_store(docs.filter("doc_id > 40"), scratch_path(spark, "store"))
    spark.read.parquet(f"{other}/dictionary").write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(Exception, match="needs dictionary"):
        token_store.read_store(spark, path).collect()


def test_byte_bpe_is_that_of_the_library_and_decodes_to_the_text(spark, docs, texts):
    import public_tokenizers
    import tiktoken

    with open(byte_bpe.vocabulary_path(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs, keep=["doc_id"]))).collect()

    def digest(ids):
        return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()

    want = [(d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t, _ in texts]
    want = [(d, len(i), digest(i), hashlib.sha256(t).hexdigest()) for d, i, t in want]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


PAGE = (
    "<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>"
    "<div class='cookie-notice'>We use cookies, many, many, cookies, as all do, really.</div>{}"
    "<aside>Side, side, and more side text, that is long, is here.</aside>"
    "<div id=comments><p>First! A long comment, with commas, commas, commas, and more, to win.</p></div>"
    "<form><p>Sign up, now, or never, please, do it, today or tomorrow.</p></form><footer>&copy; 2024</footer></body></html>"
)
STORY = "<p>One, two &amp; three,\n four: a long enough paragraph.<p>Then <b>bo</b>ld text, which goes on, and on, for long.<br>End."
CLEAN = "One, two & three, four: a long enough paragraph. Then bold text, which goes on, and on, for long. End."


@pytest.mark.parametrize(
    "body",
    [
        f"<article>{STORY}</article>",
        f"<main><script>var x = '<p>';</script>{STORY}</main>",
        f"<div class=content><!-- ad --><div class=ad>Buy, buy, buy, and buy, all of it, today.</div>{STORY}</div>",
        f"<div><div><ul class=menu><li><a href=a>A</a><li><a href=b>B</a></ul>{STORY}</div></div>",
    ],
)
def test_html_keeps_the_story_alone(body):
    assert html_text.main_text(PAGE.replace("{}", body)) == CLEAN


INSIDE = [
    ("<div class='share-story'><p>The share price fell, and fell, and fell again.</p></div>", "The share price fell, and fell, and fell again."),
    ("<p class='header-note'>A note under the header, of some length, is text.</p>", "A note under the header, of some length, is text."),
    ("<div class='comments-section'><p>First! A comment, with commas, and more.</p></div>", ""),
    ("<div id=ad-slot-3><p>Buy, buy, buy, and buy, all of it, today.</p></div>", ""),
    ("<div class='box related posts'><p>Read, also, these, and those, of last year.</p></div>", ""),
]


@pytest.mark.parametrize("part, text", INSIDE)
def test_html_keeps_parts_of_an_article_by_what_their_names_say(part, text):
    body = f"<article>{STORY}{part}</article>"
    assert html_text.main_text(PAGE.replace("{}", body)) == f"{CLEAN} {text}".strip()


def test_html_keeps_a_short_part_beside_the_long_one():
    body = f"<div class=part1>{STORY * 3}</div><div class=part2><p>A last, short part of it.</p></div>"
    assert html_text.main_text(f"<body><div>{body}</div></body>") == f"{CLEAN} {CLEAN} {CLEAN} A last, short part of it."


UNITS = ["<script ", "<div>", '<a "', "<a \"'", "<a", "</b></i>", "<i><div>" + "<b>" * 50 + "</i>", "</script", "<a x", "<p><b>", "<![CDATA[", "<!-", "<script></script", "<a \"'>", "<td>", "<!--", "&#38;<"]


@pytest.mark.parametrize("unit", UNITS)
def test_html_takes_time_in_proportion(unit):
    def seconds(n):
        page, began = (unit * (n // len(unit) + 1))[:n], time.perf_counter()
        html_text.main_text(page)
        return time.perf_counter() - began

    seconds(2000)
    assert seconds(64_000) < 12 * max(seconds(16_000), 0.01)


def plain_points(tree):
    """Points by their definition: every paragraph's gain handed up, text lengths found by walking down."""
    n = len(tree.tag)

    def texts(x, links=False, inside=False):
        inside = inside or tree.tag[x] == "a"
        if tree.out[x]:
            return 0
        own = sum(len(p.strip()) for p in tree.parts[x] if isinstance(p, str)) if inside or not links else 0
        return own + sum(texts(p, links, inside) for p in tree.parts[x] if not isinstance(p, str))

    def ancestors(x):
        while x >= 0:
            yield x
            x = tree.up[x]

    points = list(tree.weight)
    for x in range(n):
        if x and tree.tag[x] not in html_text.BLOCK:
            continue
        own = [
            p for y in range(n) if not tree.out[y] and not any(tree.tag[z] == "a" for z in ancestors(y))
            and next((z for z in ancestors(y) if z == 0 or tree.tag[z] in html_text.BLOCK)) == x for p in tree.parts[y] if isinstance(p, str)
        ]
        length = sum(len(p.strip()) for p in own)
        if length < html_text.LEAST:
            continue
        gain = 1 + sum(p.count(c) for p in own for c in ",、،，") + min(length / 100, 3)
        for level, y in enumerate([*ancestors(x)][:6]):
            points[y] += gain * (tree.tag[x] in html_text.CONTAINER) if level == 0 else 0
        for level, y in enumerate([*ancestors(tree.up[x])][:5]):
            points[y] += gain if level == 0 else gain / 2 if level == 1 else gain / (3 * level)
    linked = [any(tree.tag[z] == "a" for z in ancestors(x)) for x in range(n)]
    return [p * (1 - texts(x, True, linked[x]) / texts(x)) if texts(x) else 0.0 for x, p in enumerate(points)]


def test_html_points_equal_a_plain_scorer():
    r = random.Random(8)
    pieces = ["<div>", "</div>", "<p>", "</p>", "<section class=story>", "</section>", "<a href=x>", "</a>", "<ul><li>", "</ul>", "<b>", "</b>"]
    pieces += ["Short, ", "A text of some length, with commas, and more, to count as a paragraph. ", "<div class=ad>", "<article>", "</article>"]
    for _ in range(150):
        tree = html_text.Tree("".join(r.choice(pieces) for _ in range(r.randrange(30))))
        got = tree.score()[0]
        want = plain_points(tree)
        for x in range(1, len(got)):
            # Lengths below a left-out element do not count, and neither do its points.
            assert tree.out[x] or got[x] == pytest.approx(want[x]), x


def test_html_of_awkward_pages(spark):
    deep = "<div>" * 5000 + "deep text that is long enough to count" + "</div>" * 5000
    rows = [(1, None, "a"), (2, "", "b"), (None, "<p>x", "c"), (3, deep, "d"), (3, deep, "d"), (4, "a < b &am &lt; <", "e")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = {(r.page_id, r.text) for r in html_text.extract(pages, keep=["page_id"]).select("row.page_id", "text").collect()}
    assert got == {(1, ""), (2, ""), (None, "x"), (3, "deep text that is long enough to count"), (4, "a < b &am < <")}
    assert html_text.extract(pages.limit(0)).count() == 0


def plain_counts(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    seen, hit = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            hit.update(p + j for p in places for j in range(3))
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_statistics_are_those_of_a_plain_count(docs, texts):
    got = quality_rules.text_statistics(docs, keep=["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(d, *plain_counts(t)) for d, t, _ in texts], key=str)


def test_decision_list_finds_the_thresholds():
    r = np.random.default_rng(1)
    x = {"symbol_share": r.random(3000), "words": r.random(3000) * 100}
    bad = (x["symbol_share"] > 0.8) | ((x["words"] < 20) & (x["symbol_share"] > 0.4))
    rules = quality_rules.learn_rules(x, bad)
    covered = np.zeros(3000, bool)
    for rule in rules:
        covered |= quality_rules._holds(x, rule.conditions)
    assert (covered & ~bad).sum() <= 0.03 * covered.sum() and (covered & bad).sum() > 0.95 * bad.sum()
    assert quality_rules.learn_rules(x, np.zeros(3000, bool)) == []


def test_rules_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    judged = quality_rules.op10_quality_rules(spark, sf_dir).join(documents(spark, sf_dir, "labels"), "doc_id")
    rows = judged.filter("quality IS NOT NULL").filter(~in_training_fold()).collect()
    assert all(r.kept for r in rows if r.quality == 1 and not r.base_failed)
    assert sum(not r.kept for r in rows if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in rows)


def test_a_condition_is_the_best_of_all():
    """Growing a rule next to a search over every feature, bound and side."""
    r = np.random.default_rng(5)
    for _ in range(20):
        x = {n: r.integers(0, 6, 60).astype(float) for n in "abc"}
        bad = (x["a"] >= 3) & (x["b"] < 4) ^ (r.random(60) < 0.1)
        p, n = int(bad.sum()), int((~bad).sum())
        if not p or not n:
            continue

        def gain(mask, p=p, n=n, bad=bad):
            pos = int((mask & bad).sum())
            return pos * (np.log2(pos / mask.sum()) - np.log2(p / (p + n))) if pos else 0.0

        every = [
            gain((v >= b) if above else (v < b))
            for v in x.values() for b in (np.unique(v)[1:] + np.unique(v)[:-1]) / 2 for above in (True, False)
        ]
        first = quality_rules._grow(x, bad, 1)
        assert (gain(quality_rules._holds(x, first)) if first else 0.0) == pytest.approx(max(every))


def test_the_learned_list_judges_as_plain_python_does(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = documents(spark, sf_dir)
    rules = quality_rules.fit(docs, documents(spark, sf_dir, "labels"))
    assert rules
    for row in quality_rules.apply_rules(docs, rules, keep=["doc_id"]).collect():
        value = {}
        for name, text in quality_rules.FEATURES.items():
            top, _, below = text.partition(" / ")
            value[name] = (row[top] / row[below] if row[below] else 0.0) if below else float(row[top])
        first = next((i for i, rule in enumerate(rules, 1) if all((value[n] >= b) == above for n, above, b in rule.conditions)), None)
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert (row.rule, row.kept) == ((0, False) if failed else (first, first is None))


def test_language_of_held_out_texts(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = language_id.op7_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id")
    rows = got.filter("held_out AND lang IS NOT NULL AND text IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_texts(docs, empty, texts):
    model = language_id.fit(docs)
    got = language_id.predict(docs, model, keep=["doc_id"]).select("row.doc_id", "lang_pred").collect()
    none = {(d, "und") for d, t, _ in texts if not any(c.isalpha() for c in t or "")}
    assert {tuple(r) for r in got if r.lang_pred == "und"} == none and len(got) == len(texts)
    blank = language_id.fit(empty)
    assert {r.lang_pred for r in language_id.predict(docs, blank, keep=["doc_id"]).collect()} == {"und"}


def plain_languages(train, texts):
    """[(language, share)] by the definition: words first, then the longest length with any known n-gram."""
    import math
    import re
    import unicodedata

    def words_of(text):
        return [w for w in re.split(r"[\W\d_]+", (text or "").lower()) if w and all(unicodedata.category(c)[0] == "L" for c in w)]

    def grams(word, n):
        marked = f"\n{word}\n"
        return [g for g in (marked[i : i + n] for i in range(len(marked) - n + 1)) if n > 1 or g != "\n"]

    languages = sorted({lang for _, lang in train})
    counts = {n: {x: Counter() for x in languages} for n in range(5)}
    for text, lang in train:
        for w in words_of(text):
            counts[0][lang][w] += 1
            for n in range(1, 5):
                counts[n][lang].update(grams(w, n))
    kinds = {n: len(set().union(*counts[n].values())) for n in counts}

    def logs(n, key):
        if not any(counts[n][x][key] for x in languages):
            return None
        return [math.log((counts[n][x][key] + 0.5) / (counts[n][x].total() + 0.5 * kinds[n])) for x in languages]

    def score(word):
        found = logs(0, word)
        for n in (4, 3, 2, 1):
            if found is None:
                known = [v for v in (logs(n, g) for g in grams(word, n)) if v]
                found = [sum(c) / len(known) for c in zip(*known)] if known else None
        return found or [0.0] * len(languages)

    out = []
    for text in texts:
        words = words_of(text)
        total = [math.log(sum(lang == x for _, lang in train) / len(train)) + sum(score(w)[j] for w in words) for j, x in enumerate(languages)]
        best = max(range(len(languages)), key=lambda j: (total[j], -j))
        out.append((languages[best], 1 / sum(math.exp(t - total[best]) for t in total)) if words else ("und", 0.0))
    return out


@pytest.mark.parametrize("limits", [(200_000, 100_000), (4, 3), (0, 0), (200_000, 2)])
def test_languages_equal_a_plain_scorer_whatever_the_tasks_receive(spark, limits):
    docs = documents(spark, "/root/testdata/sf0.001").select("doc_id", F.substring("text", 1, 300).alias("text"), "lang")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    train = [(t, x) for d, t, x in rows if t is not None and x is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    asked = [(i, t) for i, (_, t, _) in enumerate(rows) if t][:60] + [(900, None), (901, "12 !"), (902, "qqq xyzzy"), (903, "the und le " * 3)]
    model = language_id.fit(docs, *limits)
    table = spark.createDataFrame(asked, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(table, model, keep=["doc_id"]).select("row.*", "lang_pred", "score").collect()}
    for (i, _), (lang, share) in zip(asked, plain_languages(train, [t for _, t in asked])):
        assert got[i][0] == lang and got[i][1] == pytest.approx(share, abs=1e-6), i
    assert (model.frequent.whole == {0, 1, 2, 3, 4}) == (limits[1] == 100_000)


def test_grams_fall_back_to_shorter_ones():
    owner, _ = language_id.grams_of(["abc", "é"], 4)
    assert np.bincount(owner, minlength=2).tolist() == [2, 0]
    owner, _ = language_id.grams_of(["abc", "é"], 1)
    assert np.bincount(owner, minlength=2).tolist() == [3, 1]


def test_factorisation_identity_equals_the_sum_over_pairs():
    machine = quality_fm.Machine(np.sort(np.random.default_rng(0).random((12, 11)), axis=1))
    bounds, at, value = machine.features([b"some words, some more", None, b"x " * 50])
    margins, _ = machine.margins(bounds, at, value)
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        pairs = sum(
            (machine.v[at[a]] @ machine.v[at[b]]) * value[a] * value[b] for a in range(lo, hi) for b in range(a + 1, hi)
        )
        assert margins[i] == pytest.approx(pairs)


def test_quality_of_held_out_texts(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = quality_fm.op8_quality_fm(spark, sf_dir).join(documents(spark, sf_dir, "labels"), "doc_id").filter("held_out").collect()
    good, bad = [r.score for r in got if r.quality == 1], [r.score for r in got if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in got]) > 0.97


def test_quality_without_labels(spark, docs, empty, texts):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_fm.fit(docs, labels) is None and quality_rules.fit(docs, labels) == []
    assert {r.score for r in quality_fm.score(docs, None, keep=["doc_id"]).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10, 70)], labels.schema)
    machine = quality_fm.fit(docs, labels)
    assert quality_fm.score(docs, machine, keep=["doc_id"]).count() == len(texts)
    assert quality_fm.score(empty, machine).count() == 0


def test_byte_bpe_stage_decodes_to_the_text(spark, sf_dir, docs):
    want = docs.selectExpr("doc_id", "sha2(coalesce(text, ''), 256) AS decoded_sha256").collect()
    got = byte_bpe.stage(spark, docs, sf_dir).select("doc_id", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def plain_losses(rows, share, pair_share):
    """Both models by dictionaries."""
    from collections import Counter

    split = [((t or "").lower().encode().split(), target) for t, target in rows]
    out = []
    totals = [sum(len(w) for w, _ in split), sum(len(w) for w, target in split if target)]
    counts = [Counter(x for w, _ in split for x in w), Counter(x for w, target in split if target for x in w)]
    vocabulary = {x for c, n in zip(counts, totals) for x, k in c.items() if k >= share * n}
    lists = [([None, *[x if x in vocabulary else 0 for x in w]], target) for w, target in split]
    pairs = [Counter(p for w, _ in lists for p in zip(w, w[1:])), Counter(p for w, t in lists if t for p in zip(w, w[1:]))]
    kept = {p for c, n in zip(pairs, totals) for p, k in c.items() if k >= pair_share * n}

    def loss(model, a, b):
        n, c = totals[model], pairs[model]
        one = {**{x: counts[model][x] for x in vocabulary}, 0: n - sum(counts[model][x] for x in vocabulary)}
        p1 = (one[b] + lm_score.ALPHA) / (n + lm_score.ALPHA * (len(vocabulary) + 1))
        tokens, kinds = sum(k for p, k in c.items() if p[0] == a), sum(p[0] == a for p in c)
        weight = kinds / (tokens + kinds) if tokens else 1.0
        return -np.log((c[a, b] / (tokens + kinds) if (a, b) in kept and c[a, b] else 0) + weight * p1)

    for words, _ in lists:
        each = [[loss(m, a, b) for a, b in zip(words, words[1:])] for m in (1, 0)]
        out.append((len(words) - 1, *[sum(e) / max(len(e), 1) for e in each]))
    return out


def test_lm_losses_equal_those_of_plain_dictionaries(spark, texts):
    rows = [(i, t, i % 3 == 0) for i, (_, t, _) in enumerate(texts[:40])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, target boolean").repartition(3)
    for share, pair_share in ((1e-3, 1e-3), (0.01, 0.004)):
        models = lm_score.fit(frame, share, pair_share)
        got = lm_score.score(frame, models, keep=["doc_id"]).orderBy("row.doc_id").collect()
        want = plain_losses([(t, target) for _, t, target in rows], share, pair_share)
        for r, (n, target, background) in zip(got, want):
            assert r.n_tokens == n
            assert (r.target_loss, r.background_loss) == pytest.approx((target, background))
            assert r.score == pytest.approx(target - background)


def check_rare_words(spark):
    """Words and pairs that occur once among 150,000 tokens keep their own counts in both models."""
    texts = ["long " * 150_000, "alpha beta gamma", "beta gamma beta", "gamma alpha", None, "beta delta epsilon"]
    rows = [(i, t, i in (1, 3)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, target boolean").repartition(3)
    got = lm_score.score(frame, lm_score.fit(frame), keep=["doc_id"]).orderBy("row.doc_id").collect()
    want = plain_losses([(t, target) for _, t, target in rows], 0, 0)
    assert [r.n_tokens for r in got] == [w[0] for w in want]
    assert [(r.target_loss, r.background_loss) for r in got] == [pytest.approx(w[1:]) for w in want]


def test_lm_keeps_rare_words_of_a_large_table(spark):
    check_rare_words(spark)


@pytest.mark.parametrize("hot", [1e-6, 0.5, 2.0])
def test_lm_losses_do_not_depend_on_what_is_sent_to_the_tasks(spark, monkeypatch, hot):
    monkeypatch.setattr(lm_score, "HOT_PAIR", hot)
    check_rare_words(spark)


def test_lm_scores_texts_that_the_models_have_not_seen(spark):
    seen = [("a b c a b", True), ("b c d", False), ("a c", True)]
    models = lm_score.fit(spark.createDataFrame(seen, "text string, target boolean"))
    row = lm_score.score(spark.createDataFrame([(1, "b a x b c")], "doc_id long, text string"), models).first()
    one = {m: Counter(w for t, x in seen if x or not m for w in t.split()) for m in (True, False)}
    two = {m: Counter(p for t, x in seen if x or not m for p in zip(["", *t.split()], t.split())) for m in (True, False)}

    def loss(m, a, b):
        tokens, kinds = sum(n for p, n in two[m].items() if p[0] == a), sum(p[0] == a for p in two[m])
        p1 = (one[m][b] + lm_score.ALPHA) / (one[m].total() + lm_score.ALPHA * 5)
        return -np.log(two[m][a, b] / max(tokens + kinds, 1) + (kinds / (tokens + kinds) if tokens else 1.0) * p1)

    words = ["", *"b a x b c".split()]
    want = [np.mean([loss(m, a, b) for a, b in zip(words, words[1:])]) for m in (True, False)]
    assert (row.target_loss, row.background_loss) == pytest.approx(want)


@pytest.mark.parametrize(("hot", "slice_bytes", "bucket_tokens"), [(1e-3, 8 << 20, 2_000_000), (0.02, 300, 2000), (2.0, 5000, 10_000)])
def test_lm_of_a_corpus_is_that_of_plain_dictionaries(spark, texts, monkeypatch, hot, slice_bytes, bucket_tokens):
    """Whatever words are hot, and however the texts and words are cut."""
    for name, value in (("HOT_WORD", hot), ("SLICE", slice_bytes), ("BUCKET_TOKENS", bucket_tokens)):
        monkeypatch.setattr(lm_corpus, name, value)
    rows = [(i, t, i % 3 == 0) for i, (_, t, _) in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, target boolean").repartition(3)
    found = lm_corpus.score_corpus(frame, keep=["doc_id"])
    got = found.orderBy("row.doc_id").collect()
    want = plain_losses([(t, target) for _, t, target in rows], 0, 0)
    assert [r.n_tokens for r in got] == [w[0] for w in want]
    assert [(r.target_loss, r.background_loss) for r in got] == [pytest.approx(w[1:]) for w in want]
    assert found.dtypes == lm_score.score(frame, lm_score.fit(frame), keep=["doc_id"]).dtypes


def test_lm_of_a_corpus_without_target_or_rows(spark, docs, empty, texts):
    found = lm_corpus.score_corpus(docs.withColumn("target", F.lit(False))).collect()
    assert len(found) == len(texts) and {r.score for r in found} == {0.0}
    assert {tuple(r.row.asDict()) for r in found} == {(*docs.columns, "target")}
    assert lm_corpus.score_corpus(empty.withColumn("target", F.lit(True))).count() == 0


def test_lm_query_stores_less_than_twice_its_documents(spark, tmp_path):
    r = random.Random(5)
    rows = [(i, " ".join(f"w{int(r.paretovariate(0.4)) % 50_000}" for _ in range(120))) for i in range(2000)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(2000)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def size(folder):
        return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet") if p.is_file())

    before = size(shared_dir(spark))
    got = lm_score.op4_lm_score(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert size(shared_dir(spark)) - before < 2 * size(tmp_path / "documents.parquet")
    frame = spark.createDataFrame([(*row, row[0] % 2 == 1) for row in rows], "doc_id long, text string, target boolean")
    want = lm_score.score(frame, lm_score.fit(frame), keep=["doc_id"]).orderBy("row.doc_id").collect()
    assert [(r.n_tokens, r.target_loss, r.background_loss) for r in got] == [pytest.approx(tuple(w)[1:4]) for w in want]


def test_lm_of_empty_tables(spark, docs, empty, texts):
    none = empty.withColumn("target", F.lit(True)).select("text", "target")
    assert lm_score.score(docs, lm_score.fit(none), keep=["doc_id"]).count() == len(texts)
    models = lm_score.fit(docs.select("text", F.lit(False).alias("target")))
    assert {r.score for r in lm_score.score(docs, models, keep=["doc_id"]).collect()} == {0.0}


def test_labelled_sample_is_bounded_when_ids_are_repeated(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(i, f"other {j}") for i in range(8) for j in range(50)] + [(9, "same")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = [tuple(r) for r in labelled_sample(docs.repartition(3), labels, "quality", 25).collect()]
    assert len(got) == len(set(got)) == 25
    assert sorted(got) == sorted(tuple(r) for r in labelled_sample(docs.repartition(5), labels, "quality", 25).collect())
    every = {tuple(r) for r in labelled_sample(docs, labels, "quality", 1000).collect()}
    learned = {r.doc_id for r in docs.filter(in_training_fold()).select("doc_id").distinct().collect()}
    assert every == {(i, t, i % 2) for i, t in rows if i in learned} and set(got) <= every
