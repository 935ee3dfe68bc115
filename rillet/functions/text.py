"""Text analysis and match expressions (T1-T4), all JVM-side column expressions.

Tokenizer: lower-cased runs of letters/digits; every Han ideograph is a token
of its own. Query strings go through the same analysis on the driver (they are
parameters, not data).
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex used inside Spark: one Han ideograph, or a run of other letters/digits.
TOKEN_PATTERN = r"(\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+)"
# Characters that continue a token which is no ideograph, for highlight bounds.
WORD_CHAR = r"[\p{L}\p{N}&&[^\p{IsHan}]]"

DEFAULT_PRE_TAG = "<em>"
DEFAULT_POST_TAG = "</em>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """array<string> of analysed tokens (document side)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 1)


# The same two classes for query strings.
_HAN = regex.compile(r"\p{Script=Han}")
_QUERY_TOKEN = regex.compile(r"(?V1)\p{Script=Han}|[[\p{L}\p{N}]--\p{Script=Han}]+")


def _is_han(ch: str) -> bool:
    return _HAN.match(ch) is not None


def analyze(query: str) -> list[str]:
    """Same analysis for a query string (driver side, parameters only)."""
    return _QUERY_TOKEN.findall((query or "").lower())


def _qarr(terms: list[str]) -> Column:
    return F.array(*[F.lit(t) for t in terms]).cast("array<string>")


def match_all(text, query: str) -> Column:
    """Every query token occurs in the text (match, operator AND)."""
    q = sorted(set(analyze(query)))
    if not q:
        return F.lit(False)
    return F.size(F.array_except(_qarr(q), tokens(text))) == 0


def match_any(text, query: str) -> Column:
    """At least one query token occurs (match, operator OR)."""
    q = sorted(set(analyze(query)))
    if not q:
        return F.lit(False)
    return F.arrays_overlap(tokens(text), _qarr(q))


def _swapped(term: str, swaps: int) -> list[str]:
    """``term`` with exactly ``swaps`` disjoint pairs of unequal neighbours exchanged."""
    if not swaps:
        return [term]
    out = []
    for k in range(len(term) - 1):
        if term[k] != term[k + 1]:
            head = term[:k] + term[k + 1] + term[k]
            out += [head + rest for rest in _swapped(term[k + 2:], swaps - 1)]
    return sorted(set(out))


def within_edits(token: Column, term: str, max_edits: int) -> Column:
    """``token`` is within ``max_edits`` insertions, deletions, substitutions and
    exchanges of neighbours of ``term``. An exchange is one edit: it is one step to the
    exchanged form of ``term`` (a parameter), whose plain distance may use what is left."""
    near = F.lit(False)
    for swaps in range(max_edits + 1):
        left = max_edits - swaps
        for form in _swapped(term, swaps):
            # the thresholded form gives -1 once the distance exceeds the rest
            near = near | F.levenshtein(token, F.lit(form), left).between(0, left)
    return near


def fuzzy_any(text, term: str, max_edits: int = 2) -> Column:
    """Every token of ``term`` lies within ``max_edits`` of some token of the text.
    An empty term matches nothing."""
    terms = sorted(set(analyze(term)))
    if not terms:
        return F.lit(False)
    toks = tokens(text)

    def near(t: str) -> Column:
        return F.exists(toks, lambda x: within_edits(x, t, max_edits))
    return reduce(and_, map(near, terms))


def highlight(text, query: str, pre_tag: str = DEFAULT_PRE_TAG,
              post_tag: str = DEFAULT_POST_TAG) -> Column:
    """T4: wrap every occurrence of a query token that is a token of the text, by the
    tokenizer's bounds: an ideograph is a token whatever stands beside it. Letters match
    in either case."""
    q = sorted(set(analyze(query)), key=lambda s: (-len(s), s))
    if not q:
        return _c(text)
    alt = "|".join(re.escape(t) if _is_han(t[0]) else f"(?<!{WORD_CHAR}){re.escape(t)}(?!{WORD_CHAR})"
                   for t in q)
    repl = pre_tag.replace("\\", "\\\\").replace("$", "\\$") + "$1" + \
        post_tag.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_c(text), F.lit(f"(?iu)({alt})"), F.lit(repl))


def term_frequency(toks: Column, term: str) -> Column:
    """Occurrences of ``term`` in a token array."""
    return F.size(F.filter(toks, lambda x: x == F.lit(term)))


#: A fragment: up to 100 characters of one sentence with its end marks, cut at white space
#: where the sentence is longer, and anywhere in a run of 100 characters without any.
FRAGMENT = r"[^.!?\n]{1,100}(?:[.!?\n]+|[ \t\r]|$)|[^.!?\n]{1,100}"


def fragments(text) -> Column:
    """array<string>: the text in sentence-bounded pieces of about 100 characters. Marks
    that no text stands before belong to no fragment."""
    return F.regexp_extract_all(_c(text), F.lit(FRAGMENT), 0)


def best_fragment(text, query: str) -> Column:
    """T4: struct(score, fragment) of the fragment with most distinct query tokens, the
    first of these; null for a text without fragments."""
    q = _qarr(sorted(set(analyze(query))))
    scored = F.transform(fragments(text), lambda f, i: F.struct(
        F.size(F.array_intersect(tokens(f), q)).alias("score"), (-i).alias("place"), f.alias("fragment")))
    best = F.array_max(scored)
    return F.when(best.isNotNull(), F.struct(best["score"].alias("score"), best["fragment"].alias("fragment")))
