"""Line dedup by a deletion-neighbourhood join, with native expressions only.

Two lines are alike when, trimmed and lower-cased, they are equal or one insertion, deletion or
substitution of a character apart (``edits``; with 0 only equal ones).  A line is dropped if a line
alike it comes earlier: in a document of smaller id, or higher up in the same one.  Whether that
earlier line is itself dropped doesn't matter.  Lines of spaces alone always stay.

1. Equal lines are grouped by hash; from here on each distinct line is one row.
2. A line is cut into four pieces, measured from its start before and from its end after the piece
   that may hold the edit.  Lines one edit apart agree on all pieces but one, so only lines that
   share three pieces with another distinct line go on, with the fourth.  A line of up to SHORT
   characters is one piece beside three empty ones, so all of it is varied.
3. Those emit their deletion variants as hashed keys: (three pieces, variant of the fourth, place)
   for every character left out of the fourth piece, and that piece as it is.  Equal variants meet
   in one shuffle: the same variant and place means a substitution, a variant equal to a whole piece
   an insertion.  Of each key's lines only the earliest is a partner, so a key shared by many lines
   makes one pair for each, not all pairs.
4. The edit distance of every pair is verified on the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free, saved

#: Lines up to this length are varied whole.  It decides the work, never the result.
SHORT = 15
#: Side of a join up to this many bytes is sent to all executors.
BROADCAST_BYTES = 32 << 20


def normal(line: Column) -> Column:
    return F.lower(F.trim(line))


def _small(df: DataFrame, row_bytes: Column) -> DataFrame:
    """``df`` (a written table) marked for broadcast if the sum of ``row_bytes`` shows that it is
    small; else joined by a shuffle."""
    size = df.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("n")).first().n
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _unit(n: Column) -> Column:
    """Length of a piece for a line of n: at most (n - 1) / 4, rounded down to four leading bits."""
    m = F.greatest(F.floor((n - 1) / 4), F.lit(1))
    low = F.greatest(F.length(F.bin(m)) - 4, F.lit(0))
    step = F.pow(F.lit(2.0), low)
    return (F.floor(m / step) * step).cast("int")


def _three_pieces(line: Column, u: Column, shorter: Column) -> Column:
    """Hashes of all but one piece, for each of the four pieces.

    ``u`` is the length of piece of the line, ``shorter`` that of a line one shorter: where they differ
    the four for that length follow.  At place 8 stands the key that all lines varied whole share.
    """
    n = F.length(line)

    def four(u: Column) -> Column:
        return F.array(*[F.xxhash64(F.lit(i), u, F.left(line, u * i), F.right(line, u * (3 - i))) for i in range(4)])

    none = F.array().cast("array<bigint>")
    long = F.when(u == shorter, four(u)).otherwise(F.concat(four(u), four(shorter)))
    whole = F.array(*[F.lit(None).cast("bigint")] * 8, F.lit(0).cast("bigint"))  # place 8: varied whole
    return F.when(n < SHORT, whole).when(n == SHORT, F.concat(four(u), F.when(u == shorter, F.array(*[F.lit(None).cast("bigint")] * 4)).otherwise(
        four(shorter)), F.array(F.lit(0).cast("bigint")))).otherwise(F.coalesce(long, none))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(document, hash of its text, line number, line) of the lines that aren't blank."""
    text = F.col(text_col).cast("string")
    split = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("t"), F.posexplode(F.split(text, "\n", -1)).alias("i", "raw"))
    return split.select("d", "t", "i", normal(F.col("raw")).alias("line")).where("line <> ''")


def _key(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h"), F.hash(line, F.lit(7)).alias("g")]


def near_dropped(docs: DataFrame, distinct: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, g) of the distinct lines with an earlier line one edit away; needs their first places."""
    keys = distinct.select("h", "g", "at", F.posexplode("three").alias("j", "key")).where("key IS NOT NULL")
    keys = keys.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("n > 1")
    near = keys.groupBy("h", "g").agg(F.any_value("at").alias("at"), F.collect_list(F.struct("j", "key")).alias("keys"))  # 9 at most
    places = saved(near.select("h", "g", "keys", "at.*"), "lines_places")
    # their texts, from the documents that hold them first
    rows = saved(places.groupBy("d", "t").agg(F.collect_list(F.struct("i", "h", "g", "keys")).alias("wanted")), "lines_wanted")
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))
    each = F.aggregate("wanted", F.lit(64), lambda a, w: a + 48 + 16 * F.size(w["keys"]))
    rows = _small(rows.withColumnsRenamed({"d": "_d", "t": "_t"}), each)
    held = source.join(rows, source["d"].eqNullSafe(F.col("_d")) & (source["t"] == F.col("_t")))
    lines = held.select("d", "t", F.split("text", "\n", -1).alias("all"), F.explode("wanted").alias("w"))
    lines = lines.select(F.struct("d", "w.i", "t").alias("at"), "w.h", "w.g", "w.keys", normal(F.get("all", F.col("w.i"))).alias("line"))
    lines = saved(lines, "lines_texts")

    parts = lines.select("h", "g", "at", "line", F.explode("keys").alias("k")).select("h", "g", "at", "line", "k.*")
    u = F.when(F.col("j") < 4, _unit(F.length("line"))).otherwise(_unit(F.length("line") - 1))
    before, after = u * (F.col("j") % 4), u * (3 - F.col("j") % 4)
    piece = F.when(F.col("j") == 8, F.col("line")).otherwise(F.substring("line", before + 1, F.length("line") - before - after))
    pieces = parts.select("h", "g", "at", "key", piece.alias("piece"))
    n = F.length("piece")
    out_of = F.transform(F.sequence(F.lit(1), n), lambda p: F.struct(
        p.alias("p"), F.xxhash64("key", F.concat(F.left("piece", p - 1), F.right("piece", n - p))).alias("v")))
    whole = F.array(F.struct(F.lit(0).alias("p"), F.xxhash64("key", "piece").alias("v")))
    keyed = pieces.select("h", "g", "at", F.explode(F.concat(whole, F.when(n > 0, out_of).otherwise(
        F.array().cast("array<struct<p:int,v:bigint>>")))).alias("k")).select("h", "g", "at", "k.*")
    # of each (variant, place) and of each variant: the earliest line
    line = F.struct("at", "h", "g")
    by_value = Window.partitionBy("v")
    met = keyed.withColumns({
        "same": F.min(line).over(Window.partitionBy("v", "p")),
        "whole": F.min(F.when(F.col("p") == 0, line)).over(by_value),
        "shorter": F.min(F.when(F.col("p") > 0, line)).over(by_value)})
    partner = F.when(F.col("p") == 0, F.array("shorter")).otherwise(F.array("whole", "same"))
    pairs = met.select("h", "g", "at", F.explode(partner).alias("o")).where("o IS NOT NULL AND o.at < at")
    pairs = pairs.select("h", "g", F.col("o.h").alias("oh"), F.col("o.g").alias("og")).distinct()
    texts = lines.select("h", "g", "line").dropDuplicates(["h", "g"])
    checked = (pairs.join(texts, ["h", "g"])
               .join(texts.select(F.col("h").alias("oh"), F.col("g").alias("og"), F.col("line").alias("other")), ["oh", "og"]))
    return checked.where(F.levenshtein("line", "other", 1) >= 0).select("h", "g").distinct()


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 1) -> DataFrame:
    """(d, t, lines): for each document with such lines, the numbers (from 0) of those to drop."""
    if edits not in (0, 1):
        raise ValueError("lines are compared with an edit bound of 0 or 1")
    every = _lines(docs, id_col, text_col).select("d", "t", "i", *_key(F.col("line")), "line")
    place = F.min(F.struct("d", "i", "t")).alias("at")
    three = [F.any_value(_three_pieces(F.col("line"), F.col("u"), F.col("s"))).alias("three")] if edits else []
    # in columns, so that each is found once a line
    cut = every.withColumns({"u": _unit(F.length("line")), "s": _unit(F.length("line") - 1)})
    distinct = saved(cut.groupBy("h", "g").agg(place, F.count(F.lit(1)).alias("n"), *three), "lines_distinct")
    none = distinct.select("h", "g").limit(0)
    near = (near_dropped(docs, distinct.select("h", "g", "at", "three"), id_col, text_col) if edits else none).withColumn("near", F.lit(True))
    # distinct lines that aren't kept everywhere: repeated ones and those with an earlier neighbour
    bad = distinct.select("h", "g", "at", "n").join(near, ["h", "g"], "left").where("n > 1 OR near")
    bad = saved(bad.select("h", "g", "at", F.coalesce("near", F.lit(False)).alias("near")), "lines_bad")
    here = F.struct("d", "i", "t")
    drop = every.select("d", "t", "i", "h", "g").join(_small(bad, F.lit(64)), ["h", "g"]).where(F.col("near") | (here != F.col("at")))
    # the lines of one document, so as large as it at most
    return drop.groupBy("d", "t").agg(F.collect_set("i").alias("lines"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 1) -> DataFrame:
    """All rows of ``docs`` with the kept lines as the text, and ``n_lines``, ``n_dropped``.

    A null text stays null and has no lines; a null id comes before all others.  Rows alike in id
    and text are one document: they keep the same lines.  Other columns stay as they are.  In an
    empty table nothing happens.  Repeated lines of one document count as repeats.  Where there are
    columns of the new ones' names already, the new ones end in ``_``.
    """
    found = saved(dropped_lines(docs, id_col, text_col, edits), "lines_dropped")
    names = docs.columns
    text = docs[text_col].cast("string")
    found = _small(found.withColumnsRenamed({"d": "_d", "t": "_t", "lines": "_lines"}), 48 + 4 * F.size("_lines"))
    lines = found["_lines"]
    joined = docs.join(found, docs[id_col].eqNullSafe(found["_d"]) & (F.xxhash64(text) == found["_t"]), "left")
    all_lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(all_lines, lambda _, i: ~F.array_contains(lines, i)), "\n")
    new = F.when(lines.isNull(), text).otherwise(kept)
    n_lines = F.coalesce(F.size(all_lines), F.lit(0)).cast("long")
    n_dropped = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    return joined.select(*[new.alias(c) if c == text_col else docs[c] for c in names],
                         n_lines.alias(free("n_lines", names)), n_dropped.alias(free("n_dropped", names)))


def sql(table: str = "documents", extra: str = "") -> str:
    """DuckDB: the lines compared by text; pairs are found among lines that share their first or
    last (n - 1) / 2 characters.  Its levenshtein counts bytes, four at most for one character, so
    the one character is looked for place by place."""
    return f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM {table}),
n AS (SELECT doc_id, i, lower(trim(raw, ' ')) AS line FROM l WHERE trim(raw, ' ') <> ''),
f AS (SELECT line, min((doc_id, i)) AS at, length(line) AS n FROM n GROUP BY line),
b AS (SELECT *, n AS c FROM f UNION ALL SELECT *, n + 1 FROM f),
p AS (SELECT x.line, y.line AS other FROM b x JOIN b y ON x.c = y.c AND x.line[1:(x.c - 1) // 2] = y.line[1:(x.c - 1) // 2]
        AND y.at < x.at AND abs(x.n - y.n) <= 1
      UNION SELECT x.line, y.line FROM b x JOIN b y ON x.c = y.c AND right(x.line, (x.c - 1) // 2) = right(y.line, (x.c - 1) // 2)
        AND y.at < x.at AND abs(x.n - y.n) <= 1),
c AS (SELECT line, CASE WHEN length(line) <= length(other) THEN line ELSE other END AS a,
        CASE WHEN length(line) <= length(other) THEN other ELSE line END AS b FROM p WHERE levenshtein(line, other) <= 4),
near AS (SELECT DISTINCT line FROM c WHERE len(list_filter(range(0, length(b)), lambda k: a[1:k] = b[1:k]
           AND a[k + 1 + length(a) - length(b) + 1:] = b[k + 2:])) > 0),
d AS (SELECT doc_id, i FROM n JOIN f USING (line) WHERE f.at <> (doc_id, i) OR line IN (SELECT line FROM near)),
k AS (SELECT l.doc_id, string_agg(raw, chr(10) ORDER BY l.i) FILTER (d.i IS NULL) AS kept, count(*) AS n_lines, count(d.i) AS n_dropped
      FROM l LEFT JOIN d ON l.doc_id = d.doc_id AND l.i = d.i GROUP BY l.doc_id)
SELECT t.doc_id, CASE WHEN t.text IS NOT NULL THEN coalesce(kept, '') END AS text, t.lang, t.source, t.n_chars,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped FROM {table} t LEFT JOIN k ON t.doc_id = k.doc_id {extra}
"""
