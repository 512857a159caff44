"""Operator 2: URL filter by host/path rules and a weighted vocabulary.

Rules come first: a rule (host, path, verdict) fits its host and all subdomains if the
url's path starts with the rule's; the longest fitting rule decides.  Other urls are
scanned once by an Aho-Corasick automaton over all terms.  A hit counts if the characters
around it are neither letters nor digits (ASCII).  Each distinct term counts once, with its
weight: strict terms weigh the whole limit, soft terms one.  At ``limit`` the url is blocked.

Map-only; the rules and terms are parameters of the caller, not data.

Cases: null urls and urls without ``://`` have empty host and path, meet no rule, and are
judged by their text alone (null: allow); every input row gives one output row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
STRICT_TERMS = ["casino", "hentai", "malware", "phishing", "porn", "porno", "spam", "viagra", "warez", "xxx"]
SOFT_TERMS = ["ads", "adult", "bet", "bets", "betting", "bonus", "cheap", "click", "dating", "escort", "farm", "free",
              "gambling", "jackpot", "nude", "pills", "poker", "sex", "slots", "track", "tracker", "win"]
LIMIT = 2

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
PARTS = re.compile(r"([^/?#]*)(/[^?#]*)?")


def host_and_path(url: str | None) -> tuple[str, str]:
    if not url or (at := url.find("://")) < 0:
        return "", ""
    host, path = PARTS.match(url, at + 3).groups()
    return host.translate(LOWER), path or ""


def index_rules(rules: list[tuple[str, str, str]]) -> dict[str, list[tuple[str, str]]]:
    by_host: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        by_host.setdefault(host, []).append((path, verdict))
    return by_host


def fitting_rule(host: str, path: str, by_host: dict) -> tuple[str | None, str | None]:
    """The longest rule that fits, as (rule, verdict)."""
    best, verdict, tail = None, None, host
    while tail:
        for p, v in by_host.get(tail, ()):
            if path.startswith(p) and (best is None or len(tail + p) > len(best)):
                best, verdict = tail + p, v
        tail = tail.partition(".")[2]
    return best, verdict


def automaton(strict: list[str], soft: list[str], limit: int):
    import ahocorasick

    a = ahocorasick.Automaton()
    for terms, weight in ((soft, 1), (strict, limit)):
        for t in terms:
            a.add_word(t.translate(LOWER), (t, weight))
    if len(a):
        a.make_automaton()
    return a


def vocabulary_weight(url: str | None, a) -> int:
    """Summed weights of the distinct terms that stand between boundaries."""
    text, found = (url or "").translate(LOWER), {}
    for end, (term, weight) in a.iter(text) if text and len(a) else ():
        before, after = end - len(term), end + 1
        if (before < 0 or text[before] not in ALNUM) and (after >= len(text) or text[after] not in ALNUM):
            found[term] = weight
    return sum(found.values())


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list = RULES,
               strict: list[str] = STRICT_TERMS, soft: list[str] = SOFT_TERMS, limit: int = LIMIT) -> DataFrame:
    """One row per page: id, host, path, rule (or null), weight of its terms, verdict (allow or block)."""
    by_host = index_rules(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(strict, soft, limit)
        for batch in batches:
            rows = []
            for url in batch.column(1).to_pylist():
                host, path = host_and_path(url)
                rule, verdict = fitting_rule(host, path, by_host)
                weight = vocabulary_weight(url, a)
                rows.append((host, path, rule, weight, verdict or ("block" if weight >= limit else "allow")))
            cols = list(zip(*rows)) or [[]] * 5
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols, kinds)],
                                             names=["id", "host", "path", "rule", "weight", "verdict"])

    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, host string, path string, rule string, weight long, verdict string")
    return out.withColumnRenamed("id", id_col)


UPPER_SQL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def oracle_sql(strict: list[str] = STRICT_TERMS, soft: list[str] = SOFT_TERMS, limit: int = LIMIT) -> str:
    """DuckDB SQL for the registered query: :data:`RULES` by length, terms as regular expressions."""
    hit = lambda t: f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT"
    weight = " + ".join([*(f"{limit} * {hit(t)}" for t in strict), *map(hit, soft)])
    by_length = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    when = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for h, p, _ in by_length)
    verdicts = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in RULES)
    return f"""
WITH rest AS (SELECT page_id, translate(coalesce(url, ''), {UPPER_SQL}) AS low,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), {UPPER_SQL}) AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, CASE {when} END AS rule, {weight} AS weight FROM parts)
SELECT page_id, host, path, rule, weight, CASE {verdicts} WHEN weight >= {limit} THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
