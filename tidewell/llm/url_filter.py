"""Op 11. URL filters: rules by host and path, and a weighted vocabulary searched for by Aho-Corasick.

A url's host is what stands between its first ``://`` and the next ``/``, ``?``, ``#`` or its end, with A-Z in lower
case; its path is what follows, up to ``?``, ``#`` or the end. A rule (action, host, path) fits its host and all
subdomains if the path starts with the rule's; of those that fit the longest decides (of equally long ones that of the
longer host, then a block). A url without a fitting rule is judged by the vocabulary: one automaton finds all terms in
one pass over the whole url, in lower case and with percent escapes read; a term counts where no letter or digit touches
it. One strict term rejects, and so do ``several`` distinct soft ones, however often each stands there.

One pass over the urls and no shuffle, so a host with a third of all rows costs nothing more. Rules and terms are
parameters, held by every task: their size is what the caller passes.

Rows: a null url, or one without ``://``, has an empty host and path; a null url is allowed. A very long url is searched
whole. Repeated rows and null page_ids are rows like others. An empty table gives an empty result. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame

Rule = tuple[str, str, str]  # action (block or allow), host, path

#: Rejected by one hit.
STRICT = ("casino", "escort", "hentai", "porn", "porno", "pornhub", "spam", "viagra", "cialis", "warez", "xxx")
#: Rejected by several distinct ones together.
SOFT = (
    "adult", "bet", "betting", "bonus", "buy", "cash", "cheap", "crack", "credit", "dating", "download", "drugs", "farm", "free", "gambling",
    "hot", "jackpot", "keygen", "loan", "loans", "lottery", "money", "nude", "payday", "pharmacy", "pills", "poker", "prize", "replica", "sex",
    "slots", "torrent", "win", "winner",
)
SEVERAL = 2

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_SCHEMA = "page_id long, host string, path string, rule string, verdict string, strict array<string>, soft array<string>"


def split(url: str | None) -> tuple[str, str]:
    """Host and path of a url; both empty where it is null or has no ``://``."""
    m = _URL.search(url or "")
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


class Filter:
    def __init__(self, rules: Sequence[Rule], strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, several: int = SEVERAL) -> None:
        import ahocorasick

        self.rules: dict[str, list[Rule]] = {}
        for rule in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block")):
            self.rules.setdefault(rule[1].translate(_UPPER), []).append(rule)
        self.order = lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block")
        self.several = several
        self.terms = ahocorasick.Automaton()
        for kind, terms in ((False, soft), (True, strict)):  # a term in both lists is strict
            for t in terms:
                self.terms.add_word(t.translate(_UPPER), (t.translate(_UPPER), kind))
        if len(self.terms):
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        best, at = None, 0
        while True:
            fits = next((r for r in self.rules.get(host[at:], ()) if path.startswith(r[2])), None)
            if fits and (best is None or self.order(fits) > self.order(best)):
                best = fits
            at = host.find(".", at) + 1
            if not at:
                return best

    def hits(self, url: str) -> tuple[list[str], list[str]]:
        """The distinct strict and soft terms in a url, in order of the alphabet."""
        text = unquote(url, errors="replace").translate(_UPPER)
        found: tuple[set[str], set[str]] = (set(), set())
        for end, (term, strict) in self.terms.iter(text) if len(self.terms) else ():
            begin = end + 1 - len(term)
            if not (begin and text[begin - 1].isalnum()) and not text[end + 1 : end + 2].isalnum():
                found[not strict].add(term)
        return sorted(found[0]), sorted(found[1])

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, list[str], list[str]]:
        host, path = split(url)
        rule = self.rule(host, path)
        strict, soft = self.hits(url or "")
        verdict = rule[0] if rule else "block" if strict or len(soft) >= self.several else "allow"
        return host, path, rule and rule[1] + rule[2], verdict, strict, soft


def judge(
    pages: DataFrame, rules: Sequence[Rule], strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, several: int = SEVERAL,
) -> DataFrame:
    """One row for each row of ``pages``: page_id, host, path, rule (null for none), verdict, and the terms found."""
    rules, strict, soft = tuple(rules), tuple(strict), tuple(soft)
    texts = pa.list_(pa.string())
    types = [pa.string()] * 4 + [texts] * 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Filter(rules, strict, soft, several)
        for batch in batches:
            found = list(zip(*(by.judge(u) for u in batch.column("url").to_pylist()), strict=True)) or [()] * len(types)
            arrays = [pa.array(x, t) for x, t in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *arrays], ["page_id", "host", "path", "rule", "verdict", "strict", "soft"],
            )

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url").mapInArrow(work, _SCHEMA)


def sql(table: str, rules: Sequence[Rule], strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, several: int = SEVERAL) -> str:
    """The same verdicts as DuckDB SQL, for rules without quotes in them."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", f"{h}{p}", a) for a, h, p in ranked]
    pick = lambda i: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[i]}'" for f in fits) + " END"
    touches = r"[\p{L}\p{N}]"
    has = lambda t: f"regexp_matches(low, '(^|[^{touches[1:-1]}]){t}([^{touches[1:-1]}]|$)')"
    return rf"""
        WITH u AS (
            SELECT page_id, coalesce(regexp_extract(url, '://([^/?#]*)', 1), '') AS h, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
                   url_decode(coalesce(url, '')) AS d FROM {table}),
        s AS (
            SELECT page_id, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   translate(d, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM u)
        SELECT page_id, host, path, {pick(1)} AS rule,
               coalesce({pick(2)}, CASE WHEN {' OR '.join(map(has, strict))} OR {' + '.join(f'({has(t)})::INT' for t in soft if t not in strict)} >= {several}
                   THEN 'block' ELSE 'allow' END) AS verdict FROM s"""
