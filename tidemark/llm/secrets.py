"""Secret scans with native expressions: three fixed forms and windows of high entropy.

Base kinds are given forms (``assign``, ``access``, ``hex``).  The kind ``entropy`` takes the
candidate strings (runs of token characters holding a letter and a digit), slides a window of
16 characters over each and finds the Shannon entropy of every window from counts that are
changed by the character that enters and the one that leaves.  A candidate's class (hex or
mixed) gives the entropy that a window must reach; the span runs from the first such window to
the end of the last.  What matches the allow-list (such as a UUID) is cut out of its run first: what
stands before and after it are candidates of their own.  A run is scanned a block at a time, so the
work is linear in its length.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base forms.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
# A run that is too short fails whole, so asking for the length in the pattern keeps the same matches.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 16
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
#: Least bits a character of a window, by class of the candidate.
THRESHOLDS = {"hex": 2.93, "mixed": 3.37}
#: Stretches of a run that match any of these are no secrets.
ALLOW = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i:example|placeholder|dummy|changeme)",
    r"0123456789|(?i:abcdefghij)",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}",  # a date
)
#: Window positions of a block of a run.
BLOCK = 256
#: n log2 n in millionths: sums of these stay exact when counts change.
_NLOGN = [round(n * math.log2(n) * 1e6) if n else 0 for n in range(WINDOW + 1)]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` found once, also where lambdas inside refer to it."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _running(steps: Column, block: int = 256) -> Column:
    """Running sums of an array, a block at a time (appending to one long array copies it)."""
    def sums(part: Column, head: Column) -> Column:
        return F.aggregate(part, F.struct(head.alias("c"), F.array().cast("array<int>").alias("all")),
                           lambda a, x: F.struct((a["c"] + x).alias("c"), F.array_append(a["all"], a["c"] + x).alias("all")),
                           lambda a: a["all"])

    at = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / block).cast("int"))
    totals = F.transform(at, lambda b: F.aggregate(F.slice(steps, b * block + 1, block), F.lit(0), lambda a, x: a + x))
    heads = let(totals, lambda t: F.concat(F.array(F.lit(0)), sums(t, F.lit(0))))
    return let(heads, lambda h: F.flatten(F.transform(
        at, lambda b: sums(F.slice(steps, b * block + 1, block), F.element_at(h, b + 1)))))


def located(text: Column, pattern: str, value: Column | None = None) -> Column:
    """Matches of a pattern as an array of (start, end, v), leftmost and non-overlapping.

    ``v`` is the match, or what ``value`` gives for it (an array that goes with the matches).
    """
    parts = F.struct(F.split(text, pattern, -1).alias("gap"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                     (value if value is not None else F.array().cast("array<string>")).alias("v"))

    def spans(p: Column) -> Column:
        step = F.transform(p["hit"], lambda _, i: F.length(F.get(p["gap"], i)) + F.when(
            i > 0, F.length(F.get(p["hit"], i - 1))).otherwise(0))
        return let(let(step, lambda n: _running(n)), lambda starts: F.transform(p["hit"], lambda m, i: F.struct(
            F.get(starts, i).alias("s"), (F.get(starts, i) + F.length(m)).alias("e"),
            (F.get(p["v"], i) if value is not None else m).alias("v"))))

    none = F.array().cast("array<struct<s:int,e:int,v:string>>")
    return F.when(text.rlike(pattern), let(parts, spans)).otherwise(none)


def _windows(v: Column, least: Column) -> Column:
    """(first, last) positions within ``v`` of the windows that reach ``least`` bits, or nulls."""
    bound = F.round(F.lit(1e6 * WINDOW) * (math.log2(WINDOW) - least)).cast("long")
    return let(bound, lambda limit: _scan(v, limit))


def _scan(v: Column, limit: Column) -> Column:
    cost = F.array(*[F.lit(x).cast("long") for x in _NLOGN])

    def count(part: Column, symbol: Column) -> Column:
        return F.length(part) - F.length(F.replace(part, symbol, F.lit("")))

    def block(text: Column) -> Column:
        """First and last position in a short string where a window that reaches the limit begins."""
        def step(st: Column, i: Column) -> Column:
            begin = F.greatest(i - (WINDOW - 1), F.lit(1))
            n = count(F.substring(text, begin, i - begin), F.substring(text, i, F.lit(1)))
            m = count(F.substring(text, i - WINDOW, F.lit(WINDOW)), F.substring(text, i - WINDOW, F.lit(1)))
            enters = F.get(cost, n + 1) - F.get(cost, n)
            leaves = F.when(i > WINDOW, F.get(cost, m) - F.get(cost, m - 1)).otherwise(0)
            return let(st["c"] + enters - leaves, lambda c: F.struct(
                c.alias("c"), F.coalesce(st["a"], F.when((i >= WINDOW) & (c <= limit), i - WINDOW)).alias("a"),
                F.when((i >= WINDOW) & (c <= limit), i - WINDOW).otherwise(st["b"]).alias("b")))

        start = F.struct(F.lit(0).cast("long").alias("c"), F.lit(None).cast("int").alias("a"), F.lit(None).cast("int").alias("b"))
        return F.aggregate(F.sequence(F.lit(1), F.length(text)), start, step, lambda st: F.struct(st["a"].alias("a"), st["b"].alias("b")))

    def scan(parts: Column) -> Column:
        # a block goes on into the next one as far as its last window
        found = F.transform(parts, lambda x, k: let(
            let(F.concat(x, F.coalesce(F.left(F.get(parts, k + 1), F.lit(WINDOW - 1)), F.lit(""))), block),
            lambda w: F.struct((w["a"] + k * BLOCK).alias("a"), (w["b"] + k * BLOCK).alias("b"))))
        # each used more than once, so found once
        return let(found, lambda f: F.struct(F.array_min(F.transform(f, lambda x: x["a"])).alias("a"),
                                             (F.array_max(F.transform(f, lambda x: x["b"])) + (WINDOW - 1)).alias("b")))

    return let(F.regexp_extract_all(v, F.lit(f".{{1,{BLOCK}}}"), F.lit(0)), scan)


def entropy_spans(text: Column, allow: tuple[str, ...] = ALLOW, thresholds: dict[str, float] = THRESHOLDS) -> Column:
    """(start, end) of the high-entropy parts of candidate strings."""
    allowed = "|".join(f"(?:{p})" for p in allow)

    def rest(x: Column) -> Column:
        """A run without its allowed stretches: what stands between them."""
        def between(hits: Column) -> Column:
            gaps = F.split(x["v"], allowed, -1)
            return F.transform(gaps, lambda g, i: F.struct(
                (x["s"] + F.when(i > 0, F.get(hits, i - 1)["e"]).otherwise(0)).alias("s"),
                (x["s"] + F.when(i > 0, F.get(hits, i - 1)["e"]).otherwise(0) + F.length(g)).alias("e"), g.alias("v")))

        return F.when(x["v"].rlike(allowed), let(located(x["v"], allowed), between)).otherwise(F.array(x)) if allow else F.array(x)

    def wanted(x: Column) -> Column:
        return (F.length(x["v"]) >= WINDOW) & x["v"].rlike("[0-9]") & x["v"].rlike("[A-Za-z]")

    def found(x: Column) -> Column:
        hexadecimal = x["v"].rlike("^([0-9a-f]+|[0-9A-F]+)$")
        least = F.when(hexadecimal, thresholds["hex"]).otherwise(thresholds["mixed"])
        return let(_windows(x["v"], least), lambda w: F.struct(
            (x["s"] + w["a"]).alias("s"), (x["s"] + w["b"] + 1).alias("e"), x["v"].alias("v")))

    # a run starts where no token character stands before it: fewer positions to try
    runs = located(text, rf"(?<![A-Za-z0-9+/_-]){CANDIDATE}")
    pieces = F.flatten(F.transform(F.filter(runs, wanted), rest))
    return F.filter(F.transform(F.filter(pieces, wanted), found), lambda x: x["s"].isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``spans`` (array of start, kind number, end) of every whole text, in order.

    Rows are independent; a null text counts as empty and has no span.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def tagged(kind: int, spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["s"].alias("start"), F.lit(kind).alias("kind"), x["e"].alias("end")))

    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.filter(located(text, ASSIGN, values), lambda x: F.length(x["v"]) >= ASSIGN_LEAST)
    spans = F.array_sort(F.concat(
        tagged(0, assign), tagged(1, located(text, rf"{ACCESS}")),
        tagged(2, located(text, rf"(?<![0-9a-f]){HEX}")), tagged(3, entropy_spans(text))))
    return docs.select(docs[id_col], spans.alias("spans"))


def text_of(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def sql(table: str = "documents") -> str:
    """DuckDB: the same spans; every window's entropy is found anew."""
    q = lambda s: s.replace("'", "''")
    allow = q("|".join(f"(?:{p})" for p in ALLOW))
    kinds = [("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("run", CANDIDATE, 0)]
    found = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS k, regexp_extract_all(t, '{q(p)}', 0) AS f, regexp_extract_all(t, '{q(p)}', {g}) AS v, "
        f"string_split_regex(t, '{q(p)}') AS gap FROM d WHERE regexp_matches(t, '{q(p)}')" for k, (_, p, g) in enumerate(kinds))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {table}),
m AS ({found}),
i AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM m),
e AS (SELECT doc_id, k, v[i] AS v, length(f[i]) AS n,
        list_sum(list_transform(gap[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS s FROM i),
r AS (SELECT doc_id, s, string_split_regex(v, '{allow}') AS gap, regexp_extract_all(v, '{allow}', 0) AS hit FROM e WHERE k = 3),
u AS (SELECT *, unnest(range(1, len(gap) + 1)) AS i FROM r),
c AS (SELECT doc_id, gap[i] AS v, length(gap[i]) AS n, s + coalesce(list_sum(list_transform(gap[1:i - 1], lambda x: length(x))), 0)
        + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: length(x))), 0) AS s FROM u),
w AS (SELECT doc_id, s, v, unnest(range(1, n - {WINDOW} + 2)) AS j FROM c
      WHERE n >= {WINDOW} AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')),
h AS (SELECT doc_id, s, min(j) AS a, max(j) AS b FROM w
      WHERE list_entropy(string_split(substr(v, j, {WINDOW}), ''))
            >= CASE WHEN regexp_matches(v, '^([0-9a-f]+|[0-9A-F]+)$') THEN {THRESHOLDS['hex']} ELSE {THRESHOLDS['mixed']} END
      GROUP BY doc_id, s),
x AS (SELECT doc_id, k, s, s + n AS e FROM e WHERE k < 3 AND (k > 0 OR length(v) >= {ASSIGN_LEAST})
      UNION ALL SELECT doc_id, 3, s + a - 1, s + b - 1 + {WINDOW} FROM h),
y AS (SELECT doc_id, k, s, ['assign', 'access', 'hex', 'entropy'][k + 1] || ':' || s::BIGINT || ':' || e::BIGINT AS p FROM x),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        count(*) FILTER (k = 3) AS n_entropy, string_agg(p, ',' ORDER BY s, k) AS spans,
        coalesce(string_agg(p, ',' ORDER BY s, k) FILTER (k < 3), '') AS base FROM y GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""
