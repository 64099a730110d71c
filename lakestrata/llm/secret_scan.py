"""Secret scans: strong spans by pattern, weak ones only where complementary parts of a credential stand together.

A credential is often written in parts: an identifier, a secret and an endpoint. Some spans are reported wherever they
stand (``BASE``). The others (``WEAK``) are too common alone; each has a role and is reported only in company:

* a weak secret near an access key, or near both a weak identifier and an endpoint;
* a weak identifier near a reported-anywhere secret, or near both a weak secret and an endpoint;
* an endpoint near an identifier and near a secret, weak or not.

*Near* means in one scope, a run of lines without a blank line between, with starts at most ``reach`` code points apart.
A weak span that overlaps a base span is part of that one already.

Patterns are matched in one pass over the texts, without a shuffle. Parts, a small share of the text, then meet in an
interval join: positions are cut into cells of ``reach``; of each cell and role only the first and last start are kept, which
decide exactly whether a part is near, and a candidate meets its own cell and the two beside it. Work is therefore in
proportion to the parts, also where one scope holds very many, and a document's rows are found by the row and not by its id.

Results: null and empty texts have no spans. Texts of any length are scanned whole, in time in proportion to their length.
Equal rows and repeated or null ids give a row each. An empty table gives no rows. Positions are code points, bytes that
are not UTF-8 count as one replacement character each; spans that begin together come in the order of ``KINDS``, then by end.
Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import documents, map_texts, stored

# The patterns and least lengths of the base spans.
_VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN = "(password|passwd|secret|token|api_?key)" + _VALUE
ACCESS = "AKIA[A-Z0-9]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

# Weak parts: name of a value, then the value; groups as in ASSIGN.
NAMED = {
    "weak": ("(pwd|pass|passphrase|credentials?|auth|(?:private|access|secret|account)_?key)" + _VALUE, 6),
    "login": ("(user|username|login|account|(?:client|key|account|user)_?id)" + _VALUE.replace("=-]", "@-]"), 2),
    "host": ("(host|hostname|endpoint|server|base_?url)" + _VALUE.replace("=-]", ":-]"), 4),
}
SHORT = 4  # an assigned value of so many characters, too short for a base span
BARE = (20, 64)  # a run with capitals, small letters and digits

KINDS = ("assign", "access", "hex", "weak", "short", "bare", "login", "email", "url", "host")
BASE = KINDS[:3]
ROLES = {
    "assign": "secret", "hex": "secret", "access": "id",
    "weak": "weak_secret", "short": "weak_secret", "bare": "weak_secret",
    "login": "weak_id", "email": "weak_id",
    "url": "endpoint", "host": "endpoint",
}
REACH = 400

_SPAN = "struct<kind: string, start: int, stop: int, scope: int>"
_SCHEMA = f"base array<{_SPAN}>, weak array<{_SPAN}>"


def _scanner():
    """The function that finds the parts of the texts of a slice."""
    assign, access = re.compile(ASSIGN, re.I | re.A), re.compile(ACCESS)
    long_hex, runs = re.compile("[0-9a-f]{%d,}" % LEAST["hex"]), re.compile("[A-Za-z0-9+/]{%d,}" % BARE[0])
    named = {kind: (re.compile(pattern, re.I | re.A), least) for kind, (pattern, least) in NAMED.items()}
    before_url, before_at = re.compile(r"[A-Za-z0-9+.-]"), re.compile(r"[A-Za-z0-9._%+-]")
    after_url = re.compile(r"""[^\x00-\x20"'<>`]+""")
    after_at = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    blank = re.compile(r"\n(?:[\t\x0b\x0c\r\x20]*\n)+")

    def around(text: str, mark: str, before: re.Pattern, after: re.Pattern, letter_first: bool):
        """Spans about each mark: found by the mark and then grown, so that long runs without one cost nothing."""
        done, at = 0, text.find(mark)
        while at >= 0:
            first = at
            while first > done and before.match(text, first - 1):
                first -= 1
            while letter_first and first < at and not text[first].isalpha():
                first += 1
            rest = after.match(text, at + len(mark))
            if first < at and rest:
                yield first, rest.end()
                done = rest.end()
            at = text.find(mark, max(done, at + len(mark)))

    def parts(text: str) -> tuple[list[tuple], list[tuple]]:
        base, weak = [], []
        for m in assign.finditer(text):
            size = m.end(2) - m.start(2)
            if size >= LEAST["assign"]:
                base.append(("assign", m.start(), m.end()))
            elif size >= SHORT:
                weak.append(("short", m.start(), m.end()))
        base += [("access", m.start(), m.end()) for m in access.finditer(text) if m.end() - m.start() >= LEAST["access"]]
        base += [("hex", m.start(), m.end()) for m in long_hex.finditer(text)]
        ends = [("url", *span) for span in around(text, "://", before_url, after_url, True)]
        pattern, least = named["host"]
        ends += [("host", m.start(), m.end()) for m in pattern.finditer(text) if m.end(2) - m.start(2) >= least]
        if not base and not ends:
            return [], []  # nothing weak can be near a strong part or an endpoint
        for kind in ("weak", "login"):
            pattern, least = named[kind]
            weak += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if m.end(2) - m.start(2) >= least]
        for m in runs.finditer(text):
            run = m.group()
            if len(run) <= BARE[1] and not (run.islower() or run.isupper()) and any(map(str.isdigit, run)) and any(
                map(str.isalpha, run)
            ):
                weak.append(("bare", m.start(), m.end()))
        weak += [("email", *span) for span in around(text, "@", before_at, after_at, False)]
        return base, weak + ends

    def placed(text: str, base: list[tuple], weak: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        """The parts by place with the number of their scope; weak ones that overlap no base span."""
        def place(part):
            return part[1], KINDS.index(part[0]), part[2]

        breaks = [m.start() for m in blank.finditer(text)]
        covered, edges = 0, []  # base spans joined where they overlap
        for _, start, stop in sorted(base, key=place):
            if edges and start < covered:
                covered = edges[-1][1] = max(covered, stop)
            else:
                covered = stop
                edges.append([start, stop])
        out, scope, e = ([], []), 0, 0
        for part in sorted([*base, *weak], key=place):
            kind, start, stop = part
            while scope < len(breaks) and breaks[scope] < start:
                scope += 1
            while e < len(edges) and edges[e][1] <= start:
                e += 1
            if kind in BASE:
                out[0].append((kind, start, stop, scope))
            elif e == len(edges) or edges[e][0] >= stop:
                out[1].append((kind, start, stop, scope))
        return out

    def scan(texts: list[bytes | None]) -> dict:
        found = [([], [])] * len(texts)
        for i, raw in enumerate(texts):
            if raw:
                text = raw.decode("utf-8", "replace")
                base, weak = parts(text)
                if base or weak:
                    found[i] = placed(text, base, weak)
        return {
            name: [[dict(zip(("kind", "start", "stop", "scope"), part)) for part in f[side]] for f in found]
            for side, name in enumerate(("base", "weak"))
        }

    return scan


def scan(docs: DataFrame) -> DataFrame:
    """``row, doc_id, base, weak`` for each document, stored: its parts, and a number for the row itself."""
    found = map_texts(docs, _scanner, _SCHEMA, keep=["doc_id"])
    found = found.select(F.monotonically_increasing_id().alias("row"), "row.doc_id", "base", "weak")
    return stored(found, "secret-parts")


def _role(kind: str | Column = "kind") -> Column:
    return reduce(lambda c, k: c.when(F.col(kind) == k, ROLES[k]), KINDS[1:], F.when(F.col(kind) == KINDS[0], ROLES[KINDS[0]]))


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """``row, kind, start, stop`` of the weak parts that stand with complementary ones: the interval join.

    ``parts`` has ``row, scope, kind, start, stop``.
    """
    roles = ("id", "secret", "weak_id", "weak_secret", "endpoint")
    cell = F.expr(f"start div {int(reach)}")
    at = parts.select("row", "scope", "kind", "start", "stop", cell.alias("cell"), _role().alias("role"))
    ends = [
        f(F.when(F.col("role") == r, F.col("start"))).alias(f"{r}_{name}")
        for r in roles
        for f, name in ((F.min, "first"), (F.max, "last"))
    ]
    marks = at.groupBy("row", "scope", "cell").agg(*ends)
    # Each cell's ends are shown to the cell before it, to itself and to the one after it.
    shown = marks.withColumn("cell", F.explode(F.array(*[F.col("cell") + i for i in (-1, 0, 1)])))
    candidates = at.filter(~F.col("kind").isin(*BASE))
    met = candidates.join(shown, ["row", "scope", "cell"])

    def near(role: str) -> Column:
        gaps = [F.abs(F.col(f"{role}_{end}") - F.col("start")) <= reach for end in ("first", "last")]
        return F.coalesce(F.max(F.coalesce(gaps[0] | gaps[1], F.lit(False))), F.lit(False)).alias(f"near_{role}")

    company = met.groupBy("row", "scope", "kind", "start", "stop", "role").agg(*[near(r) for r in roles])
    of = {r: F.col(f"near_{r}") for r in roles}
    reported = (
        F.when(F.col("role") == "weak_secret", of["id"] | (of["weak_id"] & of["endpoint"]))
        .when(F.col("role") == "weak_id", of["secret"] | (of["weak_secret"] & of["endpoint"]))
        .otherwise((of["id"] | of["weak_id"]) & (of["secret"] | of["weak_secret"]))
    )
    return company.filter(reported).select("row", "kind", "start", "stop")


def secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, base, added`` for each document: arrays of ``kind, start, stop`` by place, base spans and linked ones."""
    found = scan(docs)
    rows = found.filter("size(weak) > 0").select("row", F.explode(F.concat("base", "weak")).alias("p"))
    added = linked(rows.select("row", "p.*"), reach).groupBy("row")
    # A document's spans come from one text, so the list is bounded by it.
    added = added.agg(F.collect_list(F.struct("kind", "start", "stop")).alias("added"))
    none = F.array().cast("array<struct<kind: string, start: int, stop: int>>")
    plain = F.transform("base", lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["stop"].alias("stop")))
    all_ = found.select("row", "doc_id", plain.alias("base")).join(added, "row", "left")
    return all_.select("doc_id", "base", _in_order(F.coalesce("added", none)).alias("added"))


def _in_order(spans: Column) -> Column:
    order = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair])
    keyed = F.transform(spans, lambda p: F.struct(p["start"].alias("start"), order[p["kind"]].alias("n"), p["stop"].alias("stop"), p["kind"].alias("kind")))
    back = lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["stop"].alias("stop"))
    return F.transform(F.array_sort(keyed), back)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", p["kind"], p["start"], p["stop"])), ",")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans of each document, and all of its spans."""
    found = secrets(documents(spark, sf_dir))
    kinds = F.transform("base", lambda p: p["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(_in_order(F.concat("base", "added"))).alias("spans"),
    )


def _places(kind: str, pattern: str, keep: str, group: int = 0) -> str:
    """SQL for the matches of a pattern with their places: lengths of what lies between them, added up."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT row, text, '{kind}' AS kind, start, start + length(m) AS stop FROM (
      SELECT row, text, m, value, sum(length(gap)) OVER w + coalesce(sum(length(m)) OVER before, 0) AS start FROM (
        SELECT row, text, unnest(regexp_extract_all(text, '{quoted}')) AS m,
          unnest(regexp_extract_all(text, '{quoted}', {group})) AS value,
          unnest(regexp_split_to_array(text, '{quoted}')[:-2]) AS gap,
          unnest(range(len(regexp_extract_all(text, '{quoted}')))) AS i
        FROM docs WHERE regexp_matches(text, '{quoted}'))
      WINDOW w AS (PARTITION BY row ORDER BY i),
        before AS (PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE {keep}"""


def _either_case(pattern: str) -> str:
    """ASCII letters of the name in either case; the flag of SQL would take other alphabets' letters as well."""
    name, quote, value = pattern.partition("[\"']")
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", name) + quote + value


def _oracle() -> str:
    named = " UNION ALL ".join(
        _places(kind, _either_case(pattern), f"length(value) >= {least}", 2) for kind, (pattern, least) in NAMED.items()
    )
    assign = _either_case(ASSIGN)
    n = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    role = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{r}'" for k, r in ROLES.items()) + " END"
    base = ", ".join(f"'{k}'" for k in BASE)
    joined = f"string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, {n}, stop)"

    def near(*roles: str) -> str:
        names = ", ".join(f"'{r}'" for r in roles)
        return f"bool_or(b.role IN ({names}))"

    return rf"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    found AS (
      {_places("assign", assign, f"length(value) >= {LEAST['assign']}", 2)}
      UNION ALL {_places("short", assign, f"length(value) >= {SHORT} AND length(value) < {LEAST['assign']}", 2)}
      UNION ALL {_places("access", ACCESS, f"length(m) >= {LEAST['access']}")}
      UNION ALL {_places("hex", "[0-9a-f]+", f"length(m) >= {LEAST['hex']}")}
      UNION ALL {named}
      UNION ALL {_places("bare", "[A-Za-z0-9+/]+", f"length(m) BETWEEN {BARE[0]} AND {BARE[1]} AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')")}
      UNION ALL {_places("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE")}
      UNION ALL {_places("url", r'''[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20"'<>`]+''', "TRUE")}),
    parts AS (
      SELECT row, kind, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, {role} AS role,
        len(regexp_extract_all(left(text, CAST(start AS INTEGER)), '\n(?:[\t\x0b\x0c\r\x20]*\n)+')) AS scope
      FROM found AS f WHERE kind IN ({base}) OR NOT EXISTS (
        SELECT 1 FROM found AS b WHERE b.row = f.row AND b.kind IN ({base}) AND b.start < f.stop AND f.start < b.stop)),
    added AS (
      SELECT a.row, a.kind, a.start, a.stop FROM parts AS a
      JOIN parts AS b ON a.row = b.row AND a.scope = b.scope AND abs(a.start - b.start) <= {REACH}
      WHERE a.kind NOT IN ({base}) GROUP BY a.row, a.kind, a.start, a.stop, a.role
      HAVING CASE a.role
        WHEN 'weak_secret' THEN {near("id")} OR ({near("weak_id")} AND {near("endpoint")})
        WHEN 'weak_id' THEN {near("secret")} OR ({near("weak_secret")} AND {near("endpoint")})
        ELSE {near("id", "weak_id")} AND {near("secret", "weak_secret")} END),
    spans AS (SELECT row, kind, start, stop FROM parts WHERE kind IN ({base}) UNION ALL SELECT * FROM added),
    sums AS (SELECT row,
        {", ".join(f"CAST(count(*) FILTER (WHERE kind = '{k}') AS BIGINT) AS n_{k}" for k in BASE)},
        {joined} FILTER (WHERE kind IN ({base})) AS base, {joined} AS spans FROM spans GROUP BY row)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN sums USING (row)"""


ORACLE = _oracle()
