"""The elements of the given pages in SQL, for the second engine: a stack over tag tokens, carried by a recursive query.

It knows the tags of the given pages: scripts hold raw text, `meta` and `br` have no content, a block ends an open paragraph,
an end tag without its start tag is ignored and cannot end an element of a higher rank.
"""

from __future__ import annotations

_UNESCAPED = "replace(replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&'), '&amp', '&')"
_RANK = "CASE {0} WHEN 'div' THEN 1 WHEN 'head' THEN 6 WHEN 'body' THEN 6 WHEN 'html' THEN 7 ELSE 0 END"


def _ascii(text: str, ampersand: int) -> str:
    """Length of a text written in ASCII, other letters as numbered entities."""
    return f"""(SELECT coalesce(sum(CASE WHEN unicode(c) > 127 THEN length(CAST(unicode(c) AS VARCHAR)) + 3
        WHEN c = '&' THEN {ampersand} WHEN c IN ('<', '>') AND {ampersand} > 1 THEN 4 ELSE 1 END), 0) FROM (SELECT unnest(string_split({text}, '')) AS c))"""


def _last(tags: str, names: str) -> str:
    """Place of the last of some names in a list, 0 without any."""
    return f"coalesce(list_max(list_transform(range(1, len({tags}) + 1), lambda k: CASE WHEN {tags}[k] IN ({names}) THEN k ELSE 0 END)), 0)"


_P = _last("s.tags", "'p'")
_LI, _LIST = _last("s.tags", "'li'"), _last("s.tags", "'ul'")
_KEPT_OPEN = f"""CASE WHEN w.tag IN ('article', 'div', 'footer', 'h1', 'nav', 'p', 'ul') AND {_P} > 0 THEN {_P} - 1
        WHEN w.tag = 'li' AND {_LI} > {_LIST} THEN {_LI} - 1 ELSE len(s.tags) END"""
_KEPT_CLOSE = f"""(SELECT CASE WHEN m.at = 0 OR len(list_filter(s.tags[m.at + 1:], lambda x: {_RANK.format('x')} > {_RANK.format('w.tag')})) > 0 THEN len(s.tags) ELSE m.at - 1 END
        FROM (SELECT coalesce(list_max(list_transform(range(1, len(s.tags) + 1), lambda k: CASE WHEN s.tags[k] = w.tag THEN k ELSE 0 END)), 0) AS at) AS m)"""

# tokens: one row per tag, script or text; walk: the open elements after each; tree: one row per element.
TREE_SQL = rf"""tokens AS MATERIALIZED (
    SELECT page_id, i, t, CASE WHEN t LIKE '<script>%' THEN 'script' WHEN t LIKE '</%' THEN 'close' WHEN regexp_matches(t, '^<[a-z]') THEN 'open' WHEN t LIKE '<!%' THEN 'none' ELSE 'text' END AS kind,
           regexp_extract(t, '^</?([a-z0-9]+)', 1) AS tag
    FROM (SELECT page_id, unnest(l) AS t, generate_subscripts(l, 1) AS i FROM
      (SELECT page_id, regexp_extract_all(html, '(?s)<!--.*?-->|<script>.*?</script>|<[^>]*>|[^<]+') AS l FROM pages))),
  walk AS (
    WITH RECURSIVE steps AS (
      SELECT page_id, 0 AS i, CAST([] AS VARCHAR[]) AS tags, CAST([] AS INTEGER[]) AS ids, 0 AS next, CAST([] AS INTEGER[]) AS above FROM (SELECT DISTINCT page_id FROM tokens)
      UNION ALL
      SELECT page_id, i, CASE WHEN kind = 'open' AND tag NOT IN ('meta', 'br') THEN list_append(tags[1:kept], tag) ELSE tags[1:kept] END,
             CASE WHEN kind = 'open' AND tag NOT IN ('meta', 'br') THEN list_append(ids[1:kept], next) ELSE ids[1:kept] END,
             next + CASE WHEN kind IN ('open', 'script') THEN 1 ELSE 0 END, ids[1:kept]
      FROM (SELECT s.page_id, w.i, w.kind, w.tag, s.tags, s.ids, s.next,
                   CASE w.kind WHEN 'open' THEN {_KEPT_OPEN} WHEN 'close' THEN {_KEPT_CLOSE} ELSE len(s.tags) END AS kept
            FROM steps s JOIN tokens w ON w.page_id = s.page_id AND w.i = s.i + 1))
    SELECT page_id, i, next, above FROM steps),
  own AS MATERIALIZED (
    SELECT page_id, i, kind, tag, t, CASE WHEN kind IN ('open', 'script') THEN next - 1 END AS node_id, above,
           CASE kind WHEN 'text' THEN {_UNESCAPED.format('t')} WHEN 'script' THEN regexp_extract(t, '(?s)^<script>(.*)</script>$', 1) ELSE '' END AS text
    FROM walk JOIN tokens USING (page_id, i) WHERE kind IN ('open', 'script') OR kind = 'text' AND len(above) > 0),
  sizes AS (SELECT *, CASE kind WHEN 'text' THEN {_ascii('text', 5)} WHEN 'script' THEN {_ascii('t', 1)}
         ELSE {_ascii('t', 1)} + CASE WHEN tag IN ('meta', 'br') THEN 0 ELSE length(tag) + 3 END END AS n FROM own),
  around AS MATERIALIZED (SELECT page_id, i, text, n, node_id AS inner_id, unnest(CASE WHEN node_id IS NULL THEN above ELSE list_append(above, node_id) END) AS node_id FROM sizes),
  whole AS (SELECT page_id, node_id, max(inner_id) AS last_id, coalesce(string_agg(text, '' ORDER BY i), '') AS text, CAST(sum(n) AS INTEGER) AS html_len FROM around GROUP BY ALL),
  placed AS (SELECT page_id, node_id, tag, t, above, CASE WHEN len(above) = 0 THEN -1 ELSE above[-1] END AS parent_id, len(above) AS depth,
         row_number() OVER (PARTITION BY page_id, above, tag ORDER BY node_id) AS tag_ord, count(*) OVER (PARTITION BY page_id, above, tag) AS same,
         row_number() OVER (PARTITION BY page_id, above ORDER BY node_id) - 1 AS ord FROM own WHERE node_id IS NOT NULL),
  paths AS (SELECT p.page_id, p.node_id, string_agg('/' || a.tag || CASE WHEN a.depth > 0 AND a.same > 1 THEN '[' || a.tag_ord || ']' ELSE '' END, '' ORDER BY a.node_id) AS path
         FROM (SELECT page_id, node_id, unnest(list_append(above, node_id)) AS up FROM placed) p JOIN placed a ON a.page_id = p.page_id AND a.node_id = p.up GROUP BY ALL),
  tree AS MATERIALIZED (SELECT p.page_id, CAST(p.node_id AS INTEGER) AS node_id, CAST(p.parent_id AS INTEGER) AS parent_id, CAST(w.last_id AS INTEGER) AS last_id, CAST(p.depth AS INTEGER) AS depth,
         CAST(p.ord AS INTEGER) AS ord, CAST(p.tag_ord AS INTEGER) AS tag_ord, p.tag, p.t, p.above, w.text, w.html_len, s.path
         FROM placed p JOIN whole w USING (page_id, node_id) JOIN paths s USING (page_id, node_id))"""

# Elements with what makes two of them the same, their host and the pages of it; front, back: what all pages of a host share.
_PRINT = """SELECT a.page_id, a.node_id, string_agg((b.depth - a.depth) || b.sig, chr(3) ORDER BY b.node_id) AS print
         FROM {0} a JOIN {0} b ON b.page_id = a.page_id AND b.node_id BETWEEN a.node_id AND a.last_id GROUP BY ALL"""
_PLACE = """SELECT a.page_id, a.node_id, string_agg(CAST(b.{1} AS VARCHAR), '/' ORDER BY b.depth) AS place
         FROM (SELECT page_id, node_id, unnest(list_append(above, node_id)) AS up FROM {0}) a JOIN {0} b ON b.page_id = a.page_id AND b.node_id = a.up GROUP BY ALL"""
_SHARED = """SELECT host, place, min(tag) AS tag, n_pages FROM {0} JOIN {1} USING (page_id, node_id) JOIN {2} USING (page_id, node_id)
         WHERE depth > 0 AND n_pages >= 2 GROUP BY host, place, n_pages HAVING count(*) = n_pages AND count(DISTINCT print) = 1"""
_LEFT = """SELECT * FROM {0} t WHERE NOT EXISTS (SELECT 1 FROM {0} u JOIN {1} p USING (page_id, node_id) JOIN {2} s ON s.host = u.host AND s.place = p.place
         WHERE u.page_id = t.page_id AND u.depth > 0 AND t.node_id BETWEEN u.node_id AND u.last_id)"""
BOILERPLATE_SQL = rf"""{TREE_SQL},
  hosts AS (SELECT page_id, regexp_replace(regexp_extract(url, '^https?://([^/]*)', 1), '^www\.', '') AS host FROM pages),
  sized AS (SELECT host, count(*) AS n_pages FROM hosts WHERE page_id IN (SELECT page_id FROM tree) GROUP BY host),
  child AS (SELECT t.page_id, t.parent_id AS node_id, min(o.i) AS i FROM tree t JOIN own o USING (page_id, node_id) GROUP BY ALL),
  lead AS (SELECT o.page_id, CASE WHEN o.kind = 'script' THEN o.node_id ELSE o.above[-1] END AS node_id, string_agg(o.text, '' ORDER BY o.i) AS lead FROM own o
         LEFT JOIN child c ON c.page_id = o.page_id AND c.node_id = o.above[-1] WHERE o.kind = 'script' OR o.kind = 'text' AND (c.i IS NULL OR o.i < c.i) GROUP BY ALL),
  signed AS MATERIALIZED (SELECT t.*, n_pages, host, chr(1) || t.t || chr(2) || coalesce(l.lead, '') AS sig, row_number() OVER (PARTITION BY t.page_id, t.above ORDER BY t.node_id) AS nth
         FROM tree t JOIN hosts USING (page_id) JOIN sized USING (host) LEFT JOIN lead l USING (page_id, node_id)),
  print1 AS ({_PRINT.format('signed')}), place1 AS ({_PLACE.format('signed', 'ord')}),
  front AS MATERIALIZED ({_SHARED.format('signed', 'print1', 'place1')}),
  left1 AS MATERIALIZED (SELECT l.*, CASE WHEN depth = 0 THEN nth - 1 ELSE row_number() OVER (PARTITION BY page_id, above ORDER BY node_id DESC) - 1 END AS from_end FROM ({_LEFT.format('signed', 'place1', 'front')}) l),
  print2 AS ({_PRINT.format('left1')}), place2 AS ({_PLACE.format('left1', 'from_end')}),
  back AS MATERIALIZED ({_SHARED.format('left1', 'print2', 'place2')})"""
REMAINING_SQL = f"WITH {BOILERPLATE_SQL} SELECT host, page_id, node_id, tag, path FROM ({_LEFT.format('left1', 'place2', 'back')})"
REMOVED_SQL = f"""WITH {BOILERPLATE_SQL} SELECT host, 'front' AS direction, place, tag, n_pages FROM front
       UNION ALL SELECT host, 'back', place, tag, n_pages FROM back"""
