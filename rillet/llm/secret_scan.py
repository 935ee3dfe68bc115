"""Secret scans in DataFrame functions alone.

Base rules find assignments, access keys and long hex runs. The entropy rule takes
candidate strings (runs of base64 characters), puts each in its narrowest character
class, slides that class's window over it and keeps the stretch from the first to the
last window whose Shannon entropy reaches the class's threshold. One fold over the
candidate's characters holds the window's counts and the sum of c*log2(c), and changes
only the counts of the character that enters and of the one that leaves. Candidates on
the allow-list, or after an allowed word, are suppressed.

Spans are code points, end exclusive. Defined cases: a null text is scanned as an empty
one; repeated rows each give a row; an empty table gives an empty result; columns other
than ``doc_id`` and ``text`` are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that begin an assignment; their letters match in either case.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                   for w in KEYWORDS)
ASSIGN = rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
#: (class, characters of the whole candidate, characters it must have, window, threshold
#: in bits). The first class that holds a candidate is its class.
CLASSES = (("entropy_hex", "^[0-9a-fA-F]+$", "[0-9]", 24, 3.0),
           ("entropy_alnum", "^[A-Za-z0-9]+$", "[0-9]", 20, 3.6),
           ("entropy_base64", "^[A-Za-z0-9+/_=-]+$", "[0-9]", 20, 3.7))
#: Whole candidates that are no secrets: ids in the dashed form, numbers, words joined
#: by separators, placeholders and runs of the alphabet. (Repeated characters have no entropy.)
ALLOW = ("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "^[0-9_=/+-]+$",
         "^[A-Za-z/_=+-]+$", "(?i)example|placeholder|changeme|dummy|sample",
         "(?i)abcdefghijkl|0123456789ab")
#: What a text has before a candidate that names it a checksum.
ALLOW_BEFORE = r"""(?i)(sha-?(1|224|256|384|512)|md5|crc32|commit|checksum|digest|etag)["']?\s*[:=-]?\s*["']?\z"""
KINDS = ("assign", "access", "hex", *(c[0] for c in CLASSES))
MARK = "[SECRET]"
#: Elements of an array that are folded at once.
BLOCK = 256
_SPAN = "struct<start:int,rank:int,end:int>"


def running(values: Column, combine) -> Column:
    """Running sums or maxima of an array<int>, by blocks: a fold that appends copies what
    it has, so a long array is folded in blocks and then block by block."""
    empty = F.array().cast("array<int>")
    last = lambda out: F.coalesce(F.get(out, F.size(out) - 1), F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(BLOCK)),
                         lambda k: F.slice(values, k + 1, BLOCK))
    inner = F.transform(blocks, lambda b: F.aggregate(
        b, empty, lambda out, x: F.concat(out, F.array(combine(last(out), x)))))
    return F.aggregate(inner, empty, lambda out, b: F.concat(
        out, F.transform(b, lambda x: combine(last(out), x))))


def _found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern``: (start, match, text before since
    the last match). Splitting gives what lies between the matches, so that the lengths
    add up to positions. Nothing is built for texts without a match."""
    kind = "array<struct<start:int,m:string,p:string>>"
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits,
                       lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    ends = running(F.transform(pairs, lambda x: F.length(x["p"]) + F.length(x["m"])),
                   lambda a, b: a + b)
    placed = F.zip_with(pairs, ends, lambda x, end: F.struct(
        (end - F.length(x["m"])).alias("start"), x["m"].alias("m"), x["p"].alias("p")))
    return F.when(text.rlike(pattern), placed.cast(kind)).otherwise(F.array().cast(kind))


def _base(text: Column, kind: str, pattern: str) -> Column:
    """Spans of a base rule as (start, rank, end)."""
    hits = _found(text, pattern)
    group = (lambda m: F.regexp_extract(m, pattern, 2)) if kind == "assign" else (lambda m: m)
    good = F.filter(hits, lambda h: F.length(group(h["m"])) >= LEAST[kind])
    return F.transform(good, lambda h: F.struct(
        h["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
        (h["start"] + F.length(h["m"])).alias("end")).cast(_SPAN))


def hot_stretch(word: Column, window: int, least: float) -> Column:
    """(first, last): offsets of the stretch of ``word`` that its windows of at least
    ``least`` bits cover; null if there is none."""
    term = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)))
    codes = F.transform(F.split(word, ""), lambda c: F.ascii(c))
    size = F.length(word)
    kind = "struct<i:int,n:array<int>,s:double,first:int,last:int>"
    start = F.struct(F.lit(0).alias("i"), F.array_repeat(F.lit(0), 128).alias("n"),
                     F.lit(0.0).alias("s"), F.lit(None).cast("int").alias("first"),
                     F.lit(None).cast("int").alias("last")).cast(kind)

    def step(s, pair):
        new, old = pair["new"], pair["old"]  # old is -1 while the window fills
        a, b = F.get(s["n"], new), F.get(s["n"], old)
        total = F.when(new == old, s["s"]).otherwise(
            s["s"] + F.get(term, a + 1) - F.get(term, a)
            + F.when(old >= 0, F.get(term, b - 1) - F.get(term, b)).otherwise(0.0))
        counts = F.when(new == old, s["n"]).otherwise(F.transform(
            s["n"], lambda c, k: c + (k == new).cast("int") - (k == old).cast("int")))
        end = s["i"] + 1
        hot = (end >= window) & (F.lit(math.log2(window) - least + 1e-9) >= total / window)
        return F.struct(
            end.alias("i"), counts.alias("n"), total.alias("s"),
            F.coalesce(s["first"], F.when(hot, end - window)).alias("first"),
            F.when(hot, end).otherwise(s["last"]).alias("last")).cast(kind)

    leaving = F.concat(F.array_repeat(F.lit(-1), window),
                       F.slice(codes, 1, F.greatest(size - window, F.lit(0))))
    pairs = F.zip_with(codes, F.slice(leaving, 1, size),
                       lambda a, b: F.struct(a.alias("new"), b.alias("old")))
    done = F.aggregate(pairs, start, step, lambda s: F.struct(s["first"], s["last"]))
    return F.when(size >= window, done)


def _entropy(text: Column) -> Column:
    """Spans of the entropy rule as (start, rank, end)."""
    allowed = lambda h: F.substring(h["p"], -40, 40).rlike(ALLOW_BEFORE)
    hits = F.filter(_found(text, CANDIDATE), lambda h: ~allowed(h) & ~F.greatest(
        *(h["m"].rlike(a) for a in ALLOW)))

    def judged(h):
        verdict = None
        for kind, every, some, window, least in CLASSES:
            found = F.when(h["m"].rlike(some), F.struct(
                F.lit(KINDS.index(kind)).alias("rank"),
                hot_stretch(h["m"], window, least).alias("at")))
            verdict = (F if verdict is None else verdict).when(h["m"].rlike(every), found)
        return F.struct(h["start"].alias("start"), verdict.alias("v"))

    hot = F.filter(F.transform(hits, judged), lambda x: x["v"]["at"]["first"].isNotNull())
    return F.transform(hot, lambda x: F.struct(
        (x["start"] + x["v"]["at"]["first"]).alias("start"), x["v"]["rank"].alias("rank"),
        (x["start"] + x["v"]["at"]["last"]).alias("end")).cast(_SPAN))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def with_spans(docs: DataFrame, name: str = "spans") -> DataFrame:
    """``docs`` with an array column of (start, rank, end), ordered; rank numbers KINDS."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = [_base(text, "assign", ASSIGN), _base(text, "access", ACCESS),
             _base(text, "hex", HEX.replace("+", f"{{{LEAST['hex']},}}")), _entropy(text)]
    return docs.withColumn(name, F.array_sort(F.concat(*parts)))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: counts of the base kinds, the digest
    of the base spans, and all spans."""
    found = with_spans(docs.select("doc_id", "text"), "found")
    base = F.filter("found", lambda s: s["rank"] < 3)
    count = lambda k: F.size(F.filter("found", lambda s: s["rank"] == k)).cast("bigint")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["rank"] >= 3)).cast("bigint").alias("n_entropy"))


def redact(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """``docs`` with every span replaced by ``mark``, overlapping spans by one, and
    ``n_chars``, if there, set to the new length where the text changed."""
    rows = with_spans(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                                  F.col("text")), "found")
    rows = rows.withColumn("reach", running(F.transform("found", lambda x: x["end"]), F.greatest))
    # a span opens a cut unless an earlier one reaches beyond its start
    opens = F.filter(F.sequence(F.lit(0), F.size("found") - 1), lambda k: (k == 0) | (
        F.get(F.col("found"), k)["start"] >= F.get(F.col("reach"), k - 1)))
    rows = rows.withColumn("opens", F.when(F.size("found") > 0, opens).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("cuts", F.transform("opens", lambda k, n: F.struct(
        F.get(F.col("found"), k)["start"].alias("s"),
        F.get(F.col("reach"), F.coalesce(F.get(F.col("opens"), n + 1), F.size("found")) - 1).alias("e"))))
    ends = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c["e"]))
    pieces = F.zip_with(F.slice(ends, 1, F.size("cuts")), F.col("cuts"),
                        lambda e, c: F.concat(F.substring(F.col("text"), e + 1, c["s"] - e),
                                              F.lit(mark)))
    text = F.when(F.size("cuts") > 0, F.concat(
        F.array_join(pieces, ""),
        F.substring(F.col("text"), F.element_at(ends, -1) + 1, F.length("text")))
    ).otherwise(F.col("text"))
    rows = rows.withColumn("new", text)
    cols = []
    for c in docs.columns:
        old = F.col("row")[c]
        new = {"text": F.col("new"),
               "n_chars": F.when(F.size("cuts") > 0, F.length("new")).otherwise(old)}.get(c, old)
        cols.append(new.cast(docs.schema[c].dataType).alias(c))
    return rows.select(*cols)


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def oracle(table: str = "documents") -> str:
    """``scan`` in DuckDB SQL: every window's entropy is computed on its own."""
    base = [(k, p, f"length(regexp_extract(m, {_sql(p)}, 2)) >= 8" if k == "assign"
             else f"length(m) >= {LEAST[k]}") for k, p in
            (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX.replace("+", f"{{{LEAST['hex']},}}")))]
    rules = [*base, ("candidate", CANDIDATE, "true")]
    found = " UNION ALL ".join(f"""
  SELECT id, doc_id, '{k}' AS kind, unnest(regexp_extract_all(t, {_sql(p)})) AS m,
         unnest(string_split_regex(t, {_sql(p)})[:-2]) AS p, generate_subscripts(regexp_extract_all(t, {_sql(p)}), 1) AS i
  FROM docs WHERE regexp_matches(t, {_sql(p)})""" for k, p, _ in rules)
    kept = " UNION ALL ".join(f"SELECT id, pos AS s, {KINDS.index(k)} AS r, pos + length(m) AS e FROM placed "
                              f"WHERE kind = '{k}' AND {good}" for k, _, good in base)
    allowed = " OR ".join(f"regexp_matches(m, {_sql(a)})" for a in ALLOW)
    case = lambda value: "CASE " + " ".join(
        f"WHEN regexp_matches(m, {_sql(every)}) THEN {value(k, w, least, some)}"
        for k, every, some, w, least in CLASSES) + " END"
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM {table}),
found AS ({found}),
placed AS (SELECT *, CAST(sum(length(p)) OVER w + sum(length(m)) OVER w - length(m) AS BIGINT) AS pos
  FROM found WINDOW w AS (PARTITION BY id, kind ORDER BY i ROWS UNBOUNDED PRECEDING)),
words AS (SELECT *, {case(lambda k, w, least, some: KINDS.index(k))} AS r,
                 {case(lambda k, w, least, some: w)} AS w, {case(lambda k, w, least, some: least)} AS least,
                 {case(lambda k, w, least, some: f"regexp_matches(m, {_sql(some)})")} AS ok
  FROM placed WHERE kind = 'candidate' AND NOT regexp_matches(right(p, 40), {_sql(ALLOW_BEFORE)})
    AND NOT ({allowed})),
windows AS (SELECT *, unnest(range(0, length(m) - w + 1)) AS k FROM words WHERE ok AND length(m) >= w),
hot AS (SELECT id, pos + min(k) AS s, r, pos + max(k) + w AS e FROM windows
  WHERE list_aggregate(string_split(substr(m, k + 1, w), ''), 'entropy') >= least - 1e-9
  GROUP BY id, pos, r, w),
spans AS ({kept} UNION ALL SELECT id, s, r, e FROM hot),
named AS (SELECT *, [{names}][r + 1] || ':' || s || ':' || e AS n FROM spans),
sums AS (SELECT id, count(*) FILTER (r = 0) AS a, count(*) FILTER (r = 1) AS b, count(*) FILTER (r = 2) AS c,
                count(*) FILTER (r >= 3) AS d, string_agg(n, ',' ORDER BY s, r, e) AS every,
                string_agg(n, ',' ORDER BY s, r, e) FILTER (r < 3) AS base FROM named GROUP BY id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans, coalesce(d, 0) AS n_entropy
FROM docs LEFT JOIN sums USING (id)"""
