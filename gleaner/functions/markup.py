"""Flat scans of open tags in a page, JVM side.

Links, language tags, hidden inputs and images need no tree, so they are read from the html text with
regular expressions and never reach Python. Text inside comments, scripts and styles holds no tags.
All quantifiers are possessive and an open tag may run to the end of the page, so a broken page is read once
and never searched again from each of its tags.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import let, literal_map

_RAW = r"(?is)<(?:!--.*?(?:-->|\z)|(script|style)(?=[\s/>])[^>]*+>.*?(?=</\1|\z))"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_ATTRIBUTE = rf"[^\s/>=][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+"

# Entities with a name, from the HTML 4 table of the standard library.
_NAMED = {name: chr(code) for name, code in html.entities.name2codepoint.items()} | {"apos": "'"}


def without_raw_text(page: Column) -> Column:
    """The page without comments and without the content of scripts and styles."""
    return F.regexp_replace(page, _RAW, "<$1>")


def _tags(page: Column, name: str) -> Column:
    found = F.regexp_extract_all(page, F.lit(rf"(?is)<{name}(?=[\s/>])(?:[\s/=]++|{_ATTRIBUTE})*+(?:>|\z)"), F.lit(0))
    return F.filter(found, lambda t: F.endswith(t, F.lit(">")))


def open_tags(page: Column, tag: str) -> Column:
    """Every open tag of that name as text, in page order; `page` comes from `without_raw_text`."""
    return _tags(page, tag)


def unescape(text: Column) -> Column:
    """Decode character references that end in a semicolon."""
    pieces = F.regexp_extract_all(text, F.lit("(?s)&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);|&|[^&]++"), F.lit(0))
    names = literal_map(_NAMED)

    def number(code: Column) -> Column:
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("�")

    def decoded(p: Column) -> Column:
        body = F.substr(p, F.lit(2), F.length(p) - 2)
        return (
            F.when(~F.startswith(p, F.lit("&")) | (p == "&"), p)
            .when(p == "&amp;", F.lit("&"))
            .when(p.rlike("^&#[0-9]"), number(F.substr(body, F.lit(2)).try_cast("bigint")))
            .when(p.rlike("^&#[xX]"), number(F.conv(F.substr(body, F.lit(3)), 16, 10).try_cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(names, body), p))
        )

    return F.when(text.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(text)


def _bare(raw: Column) -> Column:
    """Value of an attribute from its text, quotes and references resolved; NULL for no value."""
    inner = F.when(raw.rlike("""^["']"""), F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    return F.when(raw != "", F.when(raw.contains("&"), let(inner, unescape)).otherwise(inner))


def _upto(name: str) -> str:
    """Pattern of the attributes before the first one called `name`, and that name."""
    return rf"(?:[\s/=]++|(?!{name}[\s=/>]){_ATTRIBUTE})*+{name}\s*+=\s*+"


def _raw_attr(tag: Column, name: str) -> Column:
    """Attribute of an open tag as it is written, '' when it has none."""
    return F.regexp_extract(tag, rf"(?is)^<[^\s/>]++{_upto(name)}({_VALUE})", 1)


def tag_attr(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name in an open tag, NULL when it has none or no value."""
    return let(_raw_attr(tag, name), _bare)


def _raw_attrs(tags: Column, name: str) -> Column:
    return F.filter(F.transform(tags, lambda t: _raw_attr(t, name)), lambda v: v != "")


def tag_attrs(page: Column, tag: str, name: str) -> Column:
    """That attribute of every open tag of that name, without the tags that lack it."""
    return F.transform(_raw_attrs(open_tags(page, tag), name), _bare)


def extract_links(page: Column) -> Column:
    """Every a@href of a page."""
    return tag_attrs(without_raw_text(page), "a", "href")


def hidden_inputs(page: Column) -> Column:
    """Map of the hidden inputs that have a name and a value; the last duplicate wins."""
    tags = F.filter(open_tags(without_raw_text(page), "input"), lambda t: tag_attr(t, "type") == "hidden")
    named = F.transform(tags, lambda t: F.struct(tag_attr(t, "name").alias("k"), tag_attr(t, "value").alias("v")))

    def last_of_each(pairs: Column) -> Column:
        names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
        return F.map_from_entries(
            F.transform(names, lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]))
        )

    return let(F.filter(named, lambda p: p["k"].isNotNull() & p["v"].isNotNull()), last_of_each)


def page_language(page: Column) -> Column:
    """Language part of the first locale a page names: html@lang, two meta forms, any xml:lang."""
    return let(without_raw_text(page), _language)


def _language(clean: Column) -> Column:
    def meta(attribute: str) -> Column:
        tags = F.filter(open_tags(clean, "meta"), lambda t: F.contains(_raw_attr(t, attribute), F.lit("anguage")))
        return F.get(F.filter(F.transform(tags, lambda t: _raw_attr(t, "content")), lambda v: v != ""), F.lit(0))

    any_tag = F.when(clean.rlike(r"(?i)xml:lang\s*="), _tags(clean, r"[a-z][^\s/>]*+"))
    locale = F.coalesce(
        F.get(_raw_attrs(open_tags(clean, "html"), "lang"), F.lit(0)),
        meta("http-equiv"),
        meta("http-name"),
        F.get(_raw_attrs(any_tag, "xml:lang"), F.lit(0)),
    )
    return F.btrim(F.split_part(let(locale, _bare), F.lit("-"), F.lit(1)), F.lit("\n"))
