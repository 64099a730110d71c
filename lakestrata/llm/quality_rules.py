"""Quality rules (operator 10): a decision list learned by sequential covering.

Statistics of each text are turned into one ordered Spark conditional expression. A rule is a conjunction of
thresholds. It is grown on two thirds of the labelled statistics, adding the condition of the highest information
gain until it covers no good document (or nothing is gained), and pruned on the last third, dropping trailing
conditions while the share of good documents it wrongly rejects does not get worse. Covered documents are
taken away and the next rule is grown on what remains.

Cases: a null or empty text has no words, so it fails the base rule. Repeated rows and repeated ids are judged
one by one and alike. An empty table gives an empty result; without labels of both kinds, only the base rule
holds. A null id is never learned from but is judged. Texts of any length are counted whole. Of conditions of equal gain the
feature named first in ``FEATURES`` wins, then the lower bound and "at least". A list has at most ``most_rules`` rules of
at most ``most_conditions`` conditions. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import documents, labelled_sample, map_texts, unpacked
from lakestrata.llm.words import Words, mix, repeated

SYMBOLS = b"#*$%&|<>"
SAMPLE = 20_000  # labelled documents that the list is learned from, at most
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MORE = "n_upper long, n_digits long, n_marks long, n_distinct long, n_lines long, n_bytes long"
_class = np.zeros((4, 256), bool)
_class[0, list(SYMBOLS)] = True
_class[1, 65:91] = True
_class[2, 48:58] = True
_class[3, list(b"!?\"'();:-_=+~^@{}[]/\\")] = True

# What a rule may test: name and expression over the counts.
FEATURES = {
    "symbol_share": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "word_length": "word_chars / n_words",
    "upper_share": "n_upper / n_bytes",
    "digit_share": "n_digits / n_bytes",
    "mark_share": "n_marks / n_words",
    "distinct_share": "n_distinct / n_words",
    "line_words": "n_words / n_lines",
    "words": "n_words",
}


def _statistics():
    def fn(texts: list[bytes | None]) -> dict:
        words = Words(texts)
        n = len(texts)
        hashes = words.hashes()
        at, grams = words.windows(hashes, 3)
        salted = words.owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        again = at[repeated(mix(grams ^ salted[at]))]
        covered = np.zeros(len(hashes) + 2, bool)
        for j in range(3):
            covered[again + j] = True
        starts = words.offsets[:-1]

        def per_text(flags: np.ndarray) -> np.ndarray:
            return np.add.reduceat(flags, starts, dtype=np.int64) if n else np.zeros(0, np.int64)

        def per_words(flags: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            return total[words.first[1:]] - total[words.first[:-1]]

        _, one = np.unique(mix(hashes ^ salted), return_index=True)
        distinct = np.zeros(len(hashes), bool)
        distinct[one] = True
        lines, dup = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i, t in enumerate(texts):
            own = [x for x in (t or b"").split(b"\n") if x.strip()]
            lines[i], dup[i] = len(own), len(own) - len(set(own))
        return {
            "n_words": words.counts,
            "word_chars": per_text(~words.white & ((words.bytes & 0xC0) != 0x80)),
            "n_symbols": per_text(_class[0][words.bytes]),
            "n_dup_lines": dup,
            "n_repeat_words": per_words(covered[: len(hashes)]),
            "n_upper": per_text(_class[1][words.bytes]),
            "n_digits": per_text(_class[2][words.bytes]),
            "n_marks": per_text(_class[3][words.bytes]),
            "n_distinct": per_words(distinct),
            "n_lines": lines,
            "n_bytes": np.diff(words.offsets) - 1,
        }

    return fn


def text_statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and the counts of each text; one pass, no shuffle."""
    return map_texts(docs, _statistics, f"{COUNTS}, {MORE}", text, keep)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Reject where every (feature, is at least, bound) holds."""

    conditions: tuple[tuple[str, bool, float], ...]
    rejected: int
    wrongly: int

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if a else '<'} {b:.4g}" for n, a, b in self.conditions)


def _holds(x: dict[str, np.ndarray], conditions) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for name, above, bound in conditions:
        out &= (x[name] >= bound) if above else (x[name] < bound)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[tuple[str, bool, float]]:
    conditions: list[tuple[str, bool, float]] = []
    inside = np.ones(len(bad), bool)
    while len(conditions) < most:
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p or not n:
            break
        best, found = 1e-9, None
        now = np.log2(p / (p + n))
        for name, values in x.items():
            v, b = values[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, cb = v[order], np.concatenate([[0], np.cumsum(b[order])])
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            if not len(cut):
                continue
            bounds = (v[cut] + v[cut - 1]) / 2
            for above in (True, False):
                pos = (p - cb[cut]) if above else cb[cut]
                size = (len(v) - cut) if above else cut
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / size) - now), 0)
                i = int(np.argmax(gain))
                if gain[i] > best:
                    best, found = gain[i], (name, above, float(bounds[i]))
        if not found:
            break
        conditions.append(found)
        inside &= _holds(x, [found])
    return conditions


def learn_rules(
    features: dict[str, np.ndarray],
    bad: np.ndarray,
    precision: float = 0.97,
    least: int = 8,
    most_rules: int = 12,
    most_conditions: int = 4,
    seed: int = 7,
) -> list[Rule]:
    """Sequential covering. A rule counts if at least ``precision`` of what it covers, on growing and pruning rows
    each, is bad and it covers ``least`` bad rows."""
    random = np.random.default_rng(seed)
    bad = np.asarray(bad, bool)
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < most_rules and (left & bad).sum() >= least:
        grow = left & (random.random(len(bad)) < 2 / 3)
        prune = left & ~grow
        sub = lambda mask: {k: v[mask] for k, v in features.items()}
        conditions = _grow(sub(grow), bad[grow], most_conditions)
        if not conditions:
            break
        held, x = bad[prune], sub(prune)

        def worth(cs, x=x, held=held) -> float:
            inside = _holds(x, cs)
            p, n = (inside & held).sum(), (inside & ~held).sum()
            return (p + 1 - n) / (p + n + 2)

        while len(conditions) > 1 and worth(conditions[:-1]) >= worth(conditions):
            conditions = conditions[:-1]
        inside = _holds(features, conditions) & left
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        pp, pn = int((inside & bad & prune).sum()), int((inside & ~bad & prune).sum())
        if p < least or p < precision * (p + n) or pp < precision * (pp + pn):
            break
        rules.append(Rule(tuple(conditions), p, n))
        left &= ~inside
    return rules


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Learn the list from at most ``sample`` labelled documents, of those that pass the base rule.

    Only their statistics, a few numbers each, reach the driver.
    """
    chosen = labelled_sample(docs, labels, "quality", sample)
    found = text_statistics(chosen, keep=["doc_id", "label"]).filter(~base_failed())
    columns = [F.coalesce(_feature(name), F.lit(0.0)).alias(name) for name in FEATURES]
    table = unpacked(found, *columns).orderBy("doc_id").toPandas()
    if table["label"].nunique() < 2:
        return []
    return learn_rules({n: table[n].to_numpy(float) for n in FEATURES}, table["label"].to_numpy() == 0)


def _feature(name: str) -> Column:
    top, _, below = FEATURES[name].partition(" / ")
    return F.expr(f"double({top}) / nullif({below}, 0)" if below else f"double({top})")


def verdict(rules: Sequence[Rule]) -> Column:
    """The number of the first rule that rejects: 0 the base rule, 1 the first learned one; null: kept."""
    out = F.when(base_failed(), F.lit(0))
    for number, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for name, above, bound in rule.conditions:
            value = F.coalesce(_feature(name), F.lit(0.0))
            holds = holds & ((value >= bound) if above else (value < bound))
        out = out.when(holds, F.lit(number))
    return out


def apply_rules(docs: DataFrame, rules: Sequence[Rule], text: str = "text", keep=None) -> DataFrame:
    """``row``, the counts, ``rule`` (which one rejected), ``base_failed`` and ``kept``."""
    found = text_statistics(docs, text, keep)
    return found.withColumns({"base_failed": base_failed(), "rule": verdict(rules)}).withColumn(
        "kept", F.col("rule").isNull()
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = fit(docs, documents(spark, sf_dir, "labels"))
    judged = apply_rules(docs, rules, keep=["doc_id"])
    return unpacked(
        judged,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.col("rule").cast("int").alias("rule"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned one rejects, with their columns."""
    rules = fit(docs, documents(spark, sf_dir, "labels"))
    return unpacked(apply_rules(docs, rules).filter("kept"))
