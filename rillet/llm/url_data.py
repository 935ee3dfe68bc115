"""Captures and a dated list history for the URL filter's query, derived from ``pages``.

The tables have no fetch times and no lists; both follow from ``page_id`` and the hosts
by fixed arithmetic, so that they grow with the pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.url_filter import host_of

#: Words of hosts that the spam list names early.
SPAM = "casino|bets|pills|ads-track"
#: (list, kind, value of the host h, condition on its digits a, b, c; first day; days until
#: removed, if it is; days until added again, if it is). Digits are 0 to 255.
RULES = (
    ("spam", "domain", "d", f"h rlike '{SPAM}' or a % 6 = 0", "a", "200 + b", "260 + b + c"),
    ("legal", "host", "h", "b % 5 = 0", "2 * b", "30 + c", None),
    ("adult", "prefix", "concat(h, '/en/')", "c % 4 = 0", "c + 100", None, None),
    ("allow", "host", "h", "(a + c) % 9 = 0", "300 + a", "100 + 2 * c", None),
)


def captures(pages: DataFrame) -> DataFrame:
    """``(page_id, url, fetched)``: a day of 2023 to 2025 for each page."""
    return pages.select("page_id", "url", F.expr(
        "date_add(date'2023-01-01', cast(pmod(page_id * 37, 1000) as int))").alias("fetched"))


def entries(pages: DataFrame) -> DataFrame:
    """``(list, kind, value, action, day, seq)`` for the hosts of the pages."""
    hosts = pages.select(host_of(F.col("url")).alias("h")).where("h <> ''").distinct()
    digits = hosts.selectExpr(
        "h", "regexp_extract(h, '([^.]+[.][^.]+[.][^.]+)$', 1) d", "md5(h) m").selectExpr(
        "h", "d", *(f"16 * ascii(substring(m, {2 * k + 1}, 1)) % 256 + ascii(substring(m, {2 * k + 2}, 1)) % 16 {n}"
                    for k, n in enumerate("abc")))
    out = None
    for name, kind, value, holds, first, gone, again in RULES:
        events = [("add", "0"), ("remove", gone), ("add", again)]
        own = digits.where(holds).selectExpr(
            f"'{name}' list", f"'{kind}' kind", f"{value} value",
            "explode(array(" + ", ".join(
                f"struct('{a}' action, date_add(date'2023-01-01', cast({first} + {d} as int)) day, {k} seq)"
                for k, (a, d) in enumerate(events) if d) + ")) e").where("value <> ''").select(
            "list", "kind", "value", "e.action", "e.day", "e.seq")
        out = own if out is None else out.union(own)
    return out


def oracle() -> str:
    """The query in DuckDB SQL, by comparing every capture with every interval."""
    parts = []
    for name, kind, value, holds, first, gone, again in RULES:
        holds = holds.replace("h rlike ", "regexp_matches(h, ").replace(f"'{SPAM}'", f"'{SPAM}')")
        events = [("add", "0"), ("remove", gone), ("add", again)]
        for k, (a, d) in enumerate(events):
            if d:
                parts.append(f"SELECT '{name}' AS list, '{kind}' AS kind, {value} AS value, '{a}' AS action, "
                             f"CAST({first} + {d} AS BIGINT) AS dy, {k} AS seq FROM digits WHERE ({holds}) "
                             f"AND ({value}) <> ''")
    digit = lambda k: (f"(16 * ascii(substr(m, {2 * k + 1}, 1)) % 256 + "  # noqa: E731
                       f"ascii(substr(m, {2 * k + 2}, 1)) % 16)")
    return f"""
WITH caps AS (
  SELECT page_id, url, (((page_id * 37) % 1000) + 1000) % 1000 AS dy,
         rtrim(lower(regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.') AS host,
         regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?', 1) AS path
  FROM pages),
hosts AS (SELECT DISTINCT host AS h, md5(host) AS m FROM caps WHERE host <> ''),
digits AS (SELECT h, regexp_extract(h, '([^.]+[.][^.]+[.][^.]+)$', 1) AS d,
                  {digit(0)} AS a, {digit(1)} AS b, {digit(2)} AS c FROM hosts),
events AS ({" UNION ALL ".join(parts)}),
daily AS (SELECT list, kind, value, dy, arg_max(action, seq) AS action FROM events GROUP BY ALL),
turns AS (SELECT *, lead(dy) OVER (PARTITION BY list, kind, value ORDER BY dy) AS gone FROM daily),
spans AS (SELECT * FROM turns WHERE action = 'add'),
found AS (
  SELECT DISTINCT c.host, c.path, c.dy, s.list, s.kind, s.value
  FROM caps c JOIN spans s ON c.dy >= s.dy AND (s.gone IS NULL OR c.dy < s.gone) AND (
    (s.kind = 'host' AND c.host = s.value)
    OR (s.kind = 'domain' AND ('.' || c.host) LIKE ('%.' || s.value))
    OR (s.kind = 'prefix' AND starts_with(c.host || c.path, s.value)))),
verdicts AS (
  SELECT host, path, dy, count(*) AS n_active, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         arg_max(list || ':' || kind || ':' || value, (length(value), list || ':' || kind || ':' || value))
           FILTER (list <> 'allow') AS rule,
         bool_or(list <> 'allow') AND NOT bool_or(list = 'allow') AS blocked
  FROM found GROUP BY ALL)
SELECT c.page_id, c.url, strftime(DATE '2023-01-01' + CAST(c.dy AS INTEGER), '%Y-%m-%d') AS fetched,
       c.host, coalesce(v.n_active, 0) AS n_active, coalesce(v.lists, '') AS lists, v.rule AS rule,
       coalesce(v.blocked, false) AS blocked
FROM caps c LEFT JOIN verdicts v ON c.host = v.host AND c.path = v.path AND c.dy = v.dy
"""
