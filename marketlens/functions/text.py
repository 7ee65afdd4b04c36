"""Text and URL expressions for news, search and documents."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Query parameters that only track clicks.
TRACKING = r"(?i)^(utm_[^=]*|fbclid|gclid|mc_cid|mc_eid)="


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


#: Assets whose news are archived.
ARCHIVED_ASSETS = ("BTC", "SPY", "GOLD", "MACRO")


def archivable(url: Column, asset: Column, title: Column) -> Column:
    """Whether a news item is archived: an asset of the list, https with a host and without user data, at most 2,048
    characters, and a title that is not blank."""
    safe = url.startswith("https://") & ~url.rlike("^https://[^/?#]*@") & ~url.rlike("^https://([/?#]|$)") & (F.length(url) <= 2048)
    return F.coalesce(asset.isin(*ARCHIVED_ASSETS) & safe & (F.trim(title) != ""), F.lit(False))


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no trailing /, no fragment, no tracking parameters nor ones without a value, the
    others sorted by name and value. Percent-encoding stays as it is."""
    head = F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=.") & ~p.rlike(TRACKING))
    kept = F.array_sort(F.transform(kept, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), p.alias("p"))))["p"]
    return F.concat(head, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def title_key(title: Column) -> Column:
    """Only a-z and 0-9 count."""
    return F.trim(F.regexp_replace(F.lower(title), r"[^a-z0-9]+", " "))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def unescape(text: Column) -> Column:
    for entity, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(ch))
    return text


def strip_markup(html: Column, most: int | None = None) -> Column:
    """Text without scripts, styles, tags and entities, space collapsed; cut at a word with an ellipsis."""
    t = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    t = F.trim(F.regexp_replace(unescape(F.regexp_replace(t, r"(?s)<[^>]*>", " ")), r"\s+", " "))
    if most is None:
        return t
    cut = F.regexp_replace(F.substring(t, 1, most), r"\s+\S*$", "")
    return F.when(F.length(t) <= most, t).otherwise(F.concat(cut, F.lit("…")))


#: What may stand before and behind a repeated title, and behind a cut.
BEFORE, BEHIND, LEFT = " #-:–", " #:-–", " ,.;:"


def excerpt(title: Column, text: Column, most: int = 280) -> Column:
    """The text, space collapsed, without its title repeated in front (whatever its case, four times at most) unless
    nothing else is there; cut at a word past 70 percent, with an ellipsis."""
    one_line = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    title, t = one_line(title), F.regexp_replace(one_line(text), r"^[.\s-]+", "")
    for _ in range(4):
        lead = F.ltrim(t, F.lit(BEFORE))
        rest = F.ltrim(F.substr(lead, F.length(title) + 1), F.lit(BEHIND))
        t = F.when((title != "") & F.lower(lead).startswith(F.lower(title)) & (rest != ""), rest).otherwise(t)
    t = F.regexp_replace(t, r"^#{1,4}\s+", "")
    head = F.rtrim(F.substring(t, 1, most))
    word = F.regexp_replace(head, r" [^ ]*$", "")
    cut = F.when((F.length(word) < F.length(head)) & (F.length(word) >= most * 0.7), word).otherwise(head)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.rtrim(cut, F.lit(LEFT)), F.lit("…")))


def on_domains(host: Column, domains) -> Column:
    """The host is one of the domains or under one."""
    out = F.lit(False)
    for d in domains:
        out = out | (host == d) | host.endswith(f".{d}")
    return out


#: Characters that a dictionary may have in all; it becomes part of a plan.
DICTIONARY = 1 << 20


def _trie(words) -> dict:
    root: dict = {}
    for w in words:
        at = root
        for c in w:
            at = at.setdefault(c, {})
        at[""] = {}
    return root


def _trie_pattern(node: dict) -> str:
    """A pattern that walks a trie: at each place one branch a character, the longest word first."""
    kids = [(c, n) for c, n in sorted(node.items()) if c]
    if not kids:
        return ""
    parts = []
    for c, n in kids:
        head = re.escape(c)
        while len(n) == 1 and "" not in n:  # a run without branches
            (c, n), = n.items()
            head += re.escape(c)
        parts.append(head + _trie_pattern(n))
    body = parts[0] if len(parts) == 1 and "" not in node else f"(?:{'|'.join(parts)})"
    return body + ("?" if "" in node else "")


def dictionary_pattern(words: list[str]) -> str:
    """One pattern for a whole dictionary: the longest word at each place, found by a walk over the words' trie."""
    if sum(map(len, words)) > DICTIONARY:
        raise ValueError(f"a dictionary of more than {DICTIONARY} characters")
    return f"(?:{_trie_pattern(_trie(words))})"


def first_topic(text: Column, dictionary: DataFrame, otherwise: str = "other") -> Column:
    """The topic of the least priority one of whose words the lower-cased text holds, anywhere.

    dictionary: word, topic, priority; rules, so it is collected. One pass finds the longest word at every place; a word
    that begins with others stands for them too. Blank words are ignored; a null text has no topic's word.
    """
    rules = [(r["word"].lower(), r["priority"], r["topic"]) for r in dictionary.select("word", "priority", "topic").where("trim(word) != ''").collect()]
    if not rules:
        return F.lit(otherwise)
    words = sorted({w for w, _, _ in rules})
    best = {w: min((p, t) for x, p, t in rules if w.startswith(x)) for w in words}
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"(?=({dictionary_pattern(words)}))"), F.lit(1)))
    ranks = F.create_map(*[x for w, (p, t) in best.items() for x in (F.lit(w), F.struct(F.lit(p).alias("p"), F.lit(t).alias("t")))])
    return F.coalesce(F.array_min(F.transform(found, lambda w: F.try_element_at(ranks, w)))["t"], F.lit(otherwise))


def replace_phrases(text: Column, dictionary: DataFrame) -> Column:
    """Phrases replaced at word bounds, whatever their case, in one pass: at the earliest place the longest phrase, whose
    replacement is not looked at again. Letters, digits and _ of any script are words.

    dictionary: phrase, replacement; rules, so it is collected. Of several replacements the least counts; blank phrases are
    ignored.
    """
    rules: dict[str, str] = {}
    for r in dictionary.select("phrase", "replacement").where("trim(phrase) != '' and replacement is not null").orderBy("phrase", "replacement").collect():
        rules.setdefault(r["phrase"].lower(), r["replacement"])
    if not rules:
        return text
    word = r"[\p{L}\p{M}\p{N}_]"
    pattern = rf"(?iu)(?<!{word}){dictionary_pattern(list(rules))}(?!{word})"
    new = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    cut = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")).cast("array<struct<g:string,m:string>>")
    put = lambda x: F.concat(x["g"], F.coalesce(F.try_element_at(new, F.lower(x["m"])), x["m"], F.lit("")))
    return F.when(text.rlike(pattern), F.array_join(F.transform(cut, put), "")).otherwise(text)


def tokens(text: Column, most: int | None = 10) -> Column:
    """Lower-case words of letters and digits (joined by _) of more than one character, the first `most`."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}](?:[\p{L}\p{N}]++(?:_[\p{L}\p{N}]++)*+|(?:_[\p{L}\p{N}]++)++)"), F.lit(0))
    return found if most is None else F.slice(found, 1, most)


@F.pandas_udf(StringType())
def nfkc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode compatibility form; Spark has no function for it."""
    for s in batches:
        yield s.str.normalize("NFKC")


def fold(t: str | None) -> str | None:
    """Lower case without accents: the compatibility decomposition less its combining marks."""
    if t is None or t.isascii():
        return t and t.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))


def news_reason(url: Column, title: Column, highlight: Column, published: Column, now: Column) -> Column:
    """Why a news item is not valid, else NULL."""
    return (
        F.when(~url.rlike(r"^https?://") | (F.length(url) > 2048), "url")
        .when(published > now + F.expr("interval 3 minutes"), "future")
        .when(F.length(F.trim(title)) < 20, "title")
        .when(F.length(F.trim(highlight)) < 50, "highlight")
        .when(F.lower(title).rlike(r"\b(api error|rate limit|forbidden|not found)\b"), "api error")
    )


def news_fresh(age_days: Column, kind: Column) -> Column:
    """At most 21 days for research, 14 for primary sources, else 7."""
    return age_days.between(0, F.when(kind == "research", 21).when(kind == "primary", 14).otherwise(7))
