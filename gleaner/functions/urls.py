"""URL functions, all JVM side. A url is split by the RFC 3986 grammar, so broken urls never raise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import let

# scheme, //authority, path, ?query, #fragment
_PARTS = r"(?s)^([a-zA-Z][a-zA-Z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def url_path(url: Column) -> Column:
    return _part(url, 3)


def url_tail(url: Column) -> Column:
    """Path, query and fragment; an empty query or fragment leaves no mark."""
    query, fragment = _part(url, 4), _part(url, 5)
    return F.concat(
        _part(url, 3), F.when(query == "?", "").otherwise(query), F.when(fragment == "#", "").otherwise(fragment)
    )


def netloc(url: Column) -> Column:
    return F.substr(_part(url, 2), F.lit(3))


def hostname(url: Column) -> Column:
    """Lower-case host without user and port, NULL when there is none."""
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#]*)", 1))
    return F.when(host != "", F.regexp_replace(host, r"^\[|\]$", ""))


def url_host(url: Column) -> Column:
    return F.regexp_replace(hostname(url), r"^www\.", "")


def is_absolute(url: Column) -> Column:
    return netloc(url) != ""


def normalize_feed_url(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("http://"), F.lit("https://")), F.lit("//www."), F.lit("//"))


def append_fragment(url: Column, fragment: str) -> Column:
    return F.concat(url, F.lit(fragment))


def url_length_filter(url: Column, limit: int = 50000) -> Column:
    """Predicate: short enough to request."""
    return F.length(url) <= limit


def unquote(text: Column) -> Column:
    """Percent-decode; a `%` that starts no escape stays."""
    safe = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(text.contains("%"), F.url_decode(safe)).otherwise(text)


def _quote_plus(text: Column) -> Column:
    return F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A"))


def query_pairs(query: Column) -> Column:
    """`array<struct<k,v>>` of a query string, without blank values."""
    pairs = F.transform(
        F.filter(F.split(query, "[&;]"), lambda p: p.rlike("(?s)=.")),
        lambda p: F.struct(
            unquote(F.replace(F.regexp_extract(p, "(?s)^([^=]*)=", 1), F.lit("+"), F.lit(" "))).alias("k"),
            unquote(F.replace(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1), F.lit("+"), F.lit(" "))).alias("v"),
        ),
    )
    return pairs


def encode_pairs(pairs: Column) -> Column:
    """Query string of the pairs: one entry per key, the last one, in key order."""

    def encode(entries: Column) -> Column:
        keys = F.array_sort(F.array_distinct(F.transform(entries, lambda p: p["k"])))

        def entry(k: Column) -> Column:
            value = F.element_at(F.filter(entries, lambda p: p["k"] == k), -1)["v"]
            return F.concat(_quote_plus(k), F.lit("="), _quote_plus(value))

        return F.array_join(F.transform(keys, entry), "&")

    return let(pairs, encode)


def _query(encoded: Column) -> Column:
    return let(encoded, lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def shrink_url(url: Column, remove: Sequence[str] = ()) -> Column:
    """Unquote, drop the listed query parameters and encode the rest again."""
    plain = unquote(url)
    path = F.substring_index(plain, "?", 1)
    kept = query_pairs(F.substr(plain, F.length(path) + 2))
    if remove:
        kept = F.filter(kept, lambda p: ~p["k"].isin(*remove))
    return F.concat(path, _query(encode_pairs(kept)))


def add_get_params(url: Column, params: Mapping[str, str] | Column) -> Column:
    """Merge parameters, a mapping or a `map<string,string>` column, into the query; new values win."""
    if isinstance(params, Column):
        added = F.transform(
            F.map_entries(params), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))
        )
    else:
        added = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(str(v)).alias("v")) for k, v in params.items()])
    query = _query(encode_pairs(F.concat(query_pairs(F.substr(_part(url, 4), F.lit(2))), added)))
    return F.concat(_part(url, 1), _part(url, 2), _part(url, 3), query, _part(url, 5))


def _remove_dots(path: Column) -> Column:
    """RFC 3986 section 5.2.4 on a rooted path."""
    segments = F.split(F.substr(path, F.lit(2)), "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    folder = F.element_at(segments, -1).isin(".", "..")
    return let(
        kept,
        lambda k: F.concat(
            F.lit("/"), F.array_join(k, "/"), F.when(folder & (F.size(k) > 0), "/").otherwise("")
        ),
    )


def url_join(base: Column, url: Column) -> Column:
    """Resolve a reference against a base url (RFC 3986 section 5.2)."""
    parts = [_part(base, i).alias(f"b{i}") for i in range(1, 6)] + [_part(url, i).alias(f"r{i}") for i in range(1, 6)]

    def resolve(p: Column) -> Column:
        root = F.when((p["b3"] == "") & (p["b2"] != ""), "/").otherwise(F.regexp_extract(p["b3"], "(?s)^(.*/)", 1))
        path = F.when(F.startswith(p["r3"], F.lit("/")), p["r3"]).otherwise(F.concat(root, p["r3"]))
        path = let(path, lambda x: F.when(x.rlike(r"^/(?:.*/)?\.\.?(/|$)"), _remove_dots(x)).otherwise(x))
        return (
            F.when(p["r1"] != "", F.concat(*[p[f"r{i}"] for i in range(1, 6)]))
            .when(p["r2"] != "", F.concat(p["b1"], *[p[f"r{i}"] for i in range(2, 6)]))
            .when(p["r3"] != "", F.concat(p["b1"], p["b2"], path, p["r4"], p["r5"]))
            .when(p["r4"] != "", F.concat(p["b1"], p["b2"], p["b3"], p["r4"], p["r5"]))
            .otherwise(F.concat(*[p[f"b{i}"] for i in range(1, 5)], p["r5"]))
        )

    return F.when(is_absolute(url) & (_part(url, 1) != ""), url).otherwise(let(F.struct(*parts), resolve))
