"""DuckDB SQL for the queries: expected values computed from the columns of the tables, not by reading the generated text again."""

from __future__ import annotations

from kasane.plans.statutes import LAWS, OUTSIDE

_NAMES = "[" + ", ".join(f"'{n}'" for n, _ in LAWS) + "]"
_IDS = "[" + ", ".join(f"'{i}'" for _, i in LAWS) + "]"


def _law(index: str) -> str:
    return f"list_extract({_NAMES}, CAST({index} AS INT) + 1)"


def _law_id(index: str) -> str:
    return f"list_extract({_IDS}, CAST({index} AS INT) + 1)"


def _kanji(n: str) -> str:
    """The numeral of a number from 1 to 9999."""
    ones = "['', '一', '二', '三', '四', '五', '六', '七', '八', '九']"
    some = lambda sign: "['', " + ", ".join(f"'{d}{sign}'" for d in ["", *"二三四五六七八九"]) + "]"
    digit = lambda unit: f"CAST(({n}) // {unit} % 10 AS INT) + 1"
    return f"(list_extract({some('千')}, {digit(1000)}) || list_extract({some('百')}, {digit(100)}) || list_extract({some('十')}, {digit(10)}) || list_extract({ones}, {digit(1)}))"


_N = "((l_partkey * 7 + l_orderkey) % 9000 + 1)"
_SOURCE = f"('JPLAW:' || {_law_id('l_orderkey % 8')} || '#main#' || (l_orderkey % 9000 + 1))"
_OWN = f"('JPLAW:' || {_law_id('l_orderkey % 8')} || '#main#' || "
_LINES = "li AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY ALL)"
_EDGES = f"""{_LINES},
e AS (SELECT l_orderkey * 10 + l_linenumber AS text_id, 0 AS ord, {_SOURCE} AS "from", {_OWN}{_N}) AS "to", '第' || {_kanji(_N)} || '条' AS evidence, NULL AS kind FROM li WHERE l_linenumber % 5 IN (0, 3)
  UNION ALL SELECT l_orderkey * 10 + l_linenumber, 1, {_SOURCE}, {_OWN}({_N} + 1)), '第' || {_kanji(_N + ' + 1')} || '条', NULL FROM li WHERE l_linenumber % 5 = 3
  UNION ALL SELECT l_orderkey * 10 + l_linenumber, 0, {_SOURCE}, 'JPLAW:' || {_law_id('(l_orderkey + 1) % 8')} || '#main#' || {_N} || '_2', '第' || {_kanji(_N)} || '条の二', NULL FROM li WHERE l_linenumber % 5 = 1
  UNION ALL SELECT l_orderkey * 10 + l_linenumber, 0, {_SOURCE}, 'external:港湾荷役法#main#' || {_N}, '第' || {_kanji(_N)} || '条', 'external_ref' FROM li WHERE l_linenumber % 5 = 2),
edges AS (SELECT * FROM e WHERE "from" <> "to")"""

_ARTICLES = f"""
articles AS (SELECT p_partkey AS pos, p_name AS heading, {_law('p_partkey % 8')} AS law_name, {_law_id('p_partkey % 8')} AS law_id,
  (p_partkey // 8 + 1) || CASE WHEN p_partkey % 7 = 0 THEN '_2' ELSE '' END AS article_num, p_partkey // 8 + 1 AS main, CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 0 END AS sub,
  p_size % 12 + 1 AS chapter_num, nullif(p_size % 3, 0) AS section_num, CASE WHEN p_partkey % 5 = 0 THEN '第章の二' ELSE '第章' END AS chapter_title, CASE WHEN p_partkey % 4 = 0 THEN '第節の二' END AS section_title,
  'JPLAW:' || {_law_id('p_partkey % 8')} || '#main#' || (p_partkey // 8 + 1) || CASE WHEN p_partkey % 7 = 0 THEN '_2' ELSE '' END AS node_id FROM part)"""
_NAME = "('第' || main || '条' || CASE WHEN sub > 0 THEN 'の2' ELSE '' END)"
_CONTAINS = """
contained AS (SELECT DISTINCT 'JPLAW:' || law_id || '#chapter#' || chapter_num AS source, node_id AS target, 'contains' AS type, 'chapter_contains_article' AS relation FROM articles
  UNION ALL SELECT DISTINCT 'JPLAW:' || law_id || '#chapter#' || chapter_num || '#section#' || section_num, node_id, 'contains', 'section_contains_article' FROM articles WHERE section_num IS NOT NULL)"""
_LINK = lambda law, n, sub, raw: f"'[[laws/' || {law} || '/本文/第' || {n} || '条{sub}.md|' || {raw} || ']]'"
_K, _K1 = f"'第' || {_kanji(_N)} || '条'", f"'第' || {_kanji(_N + ' + 1')} || '条'"
_OWN_LAW, _NEXT = _law("l_orderkey % 8"), _law("(l_orderkey + 1) % 8")
_HREFS = """hrefs AS (SELECT page_id, i, h FROM (SELECT page_id, regexp_extract_all(html, 'href="/([^"]+)"', 1) AS hs FROM pages), unnest(range(1, len(hs) + 1)) AS u(i), unnest([hs[i]]) AS v(h)),
links AS (SELECT 'pages/' || page_id || '.md' AS path, CAST(i AS INT) AS line_no, 'notes/' || trim(split_part(split_part(split_part(h, '|', 1), '#', 1), '^', 1)) AS target FROM hrefs),
files AS (SELECT DISTINCT 'notes/' || h || '.md' AS path FROM hrefs WHERE page_id % 3 = 0 AND length(h) % 2 = 0),
shown AS (SELECT path, line_no, CASE WHEN suffix(target, '.md') THEN target ELSE target || '.md' END AS shown FROM links),
broken AS (SELECT * FROM shown WHERE shown NOT IN (SELECT path FROM files))"""
_RANGES = f"""{_LINES},
alinks AS (SELECT l_orderkey * 10 + l_linenumber AS link_id, {_law('l_partkey % 8')} AS law_name, CAST(l_partkey AS INT) AS num, 's' || (l_suppkey % 20) AS source, l_linenumber <> 3 AS from_main FROM li),
ranges AS (SELECT {_law('s_suppkey % 8')} AS law_name, CAST(s_suppkey * 3 AS INT) AS start, CAST(s_suppkey * 3 + s_suppkey % 7 AS INT) AS "end" FROM supplier),
best AS (SELECT link_id, law_name, num, start, "end" FROM alinks JOIN ranges USING (law_name) WHERE num BETWEEN start AND "end"
  QUALIFY row_number() OVER (PARTITION BY link_id ORDER BY "end" - start, start DESC) = 1)"""
_PENDING = "SELECT substr(sha1(concat_ws('|', 'law' || (user_id % 40), 'p/' || event_type || '.md', '[[x' || (event_id % 50) || ']]', event_type)), 1, 16) AS id, ts, 'law' || (user_id % 40) AS law, event_id FROM events"
_SNAPSHOTS = """
b AS (SELECT CASE o_orderkey % 9 WHEN 0 THEN '章/' WHEN 1 THEN '本文/章/' ELSE '本文/' END || o_orderkey || '.md' AS path, o_orderkey, o_orderpriority AS body FROM orders WHERE o_orderkey % 10 <> 0),
a AS (SELECT CASE o_orderkey % 9 WHEN 0 THEN '章/' WHEN 1 THEN '本文/章/' ELSE '本文/' END || o_orderkey || '.md' AS path, o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'x' WHEN o_orderkey % 4 = 1 THEN ' ' || o_orderpriority ELSE o_orderpriority END AS body FROM orders WHERE o_orderkey % 11 <> 0),
files AS (SELECT coalesce(b.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'missing' WHEN b.path IS NULL AND a.o_orderkey % 9 = 0 THEN 'structure' WHEN b.path IS NULL THEN 'new' WHEN a.body = b.body THEN 'same' ELSE 'changed' END AS status FROM b FULL JOIN a ON a.path = b.path)"""
_DIFF = """
x AS (SELECT l_linenumber % 2 AS half, 'a' || (l_partkey % 500) AS source, 'b' || (l_suppkey % 50) AS target FROM lineitem),
m AS (SELECT source, target FROM x WHERE half = 0 EXCEPT ALL SELECT source, target FROM x WHERE half = 1),
n AS (SELECT source, target FROM x WHERE half = 1 EXCEPT ALL SELECT source, target FROM x WHERE half = 0),
d AS (SELECT source, target, 'missing' AS side, count(*) AS n FROM m GROUP BY ALL UNION ALL SELECT source, target, 'new', count(*) FROM n GROUP BY ALL)"""
_ERA_KANJI = "translate({}, '0123456789', '〇一二三四五六七八九')"
_BRANCH = lambda sign: f"'第' || (num // 10) || '{sign}の' || (num % 10)"

_TREES = """
t AS (SELECT CAST(conv_id AS VARCHAR) AS law_id, count(*) AS k, count(*) FILTER (WHERE turn % 2 = 1) AS odd, count(*) FILTER (WHERE turn % 3 = 0) AS k3, count(*) FILTER (WHERE turn % 6 = 3) AS odd3 FROM conversations GROUP BY ALL),
counts AS (SELECT t.*, tag, CASE tag WHEN 'SupplProvision' THEN 2 WHEN 'Section' THEN least(k3, 1) WHEN 'SectionTitle' THEN least(k3, 1) WHEN 'Article' THEN k + 1 WHEN 'ArticleCaption' THEN k WHEN 'Paragraph' THEN k + 3
    WHEN 'Item' THEN odd WHEN 'Sentence' THEN k + odd + 3 WHEN '#text' THEN 1 + least(k3, 1) + 2 * k + odd + 3 ELSE 1 END AS n
  FROM t, unnest(['Law', 'MainProvision', 'SupplProvision', 'Chapter', 'ChapterTitle', 'Section', 'SectionTitle', 'Article', 'ArticleCaption', 'Paragraph', 'Item', 'Sentence', '#text']) AS u(tag))"""

_RENAMES = """p AS (SELECT DISTINCT p_partkey // 6 AS g, p_partkey % 6 AS v FROM part),
m AS (SELECT g, v, max(v) OVER (PARTITION BY g) AS most FROM p),
ends AS (SELECT 'laws/' || g || '/v' || v || '.md' AS old, 'laws/' || g || '/v' || CASE WHEN g % 10 = 7 AND most = 5 THEN v ELSE least(most + 1, 5) END || '.md' AS new,
  CASE WHEN g % 10 = 7 AND most = 5 THEN 0 ELSE least(most + 1, 5) - v END AS steps, CASE WHEN g % 10 = 7 AND most = 5 THEN 'cycle' ELSE 'renamed' END AS status
  FROM m WHERE v < 5 OR g % 10 = 7),
moved AS (SELECT old, new FROM ends WHERE status = 'renamed'),
links AS (SELECT c_custkey, c_name, 'laws/' || (c_custkey % 40) || '/v' || (c_custkey % 6) || '.md' AS a, 'laws/' || (c_custkey % 30) || '/v' || (c_custkey % 4) || '.md' AS b,
  'laws/' || (c_custkey % 20) || '/v' || (c_custkey % 3) || '.md' AS c FROM customer),
l AS (SELECT links.*, x.new AS na, y.new AS nb, z.new AS nc FROM links LEFT JOIN moved x ON a = x.old LEFT JOIN moved y ON b = y.old LEFT JOIN moved z ON c = z.old)"""

ORACLES = {
    "q_edges": f"WITH {_EDGES} SELECT * FROM edges",
    "q_edges_text": f"""WITH {_LINES} SELECT l_orderkey * 10 + l_linenumber AS text_id, CASE l_linenumber % 5
  WHEN 0 THEN '係員は、' || {_LINK(_OWN_LAW, _N, '', _K)} || 'により記録を作る。'
  WHEN 1 THEN {_NEXT} || {_LINK(_NEXT, _N, 'の2', _K + " || 'の二'")} || 'の規定は、'
  WHEN 2 THEN '{OUTSIDE}' || {_K} || 'において'
  WHEN 3 THEN '本法' || {_LINK(_OWN_LAW, _N, '', _K)} || '、' || {_LINK(_OWN_LAW, '(' + _N + ' + 1)', '', _K1)} || 'の規定'
  ELSE {_K} || 'に見出しを付ける。' END AS text FROM li""",
    "q_scope_edges": f"""WITH x AS (SELECT o_orderkey AS text_id, o_orderkey % 15 AS t, o_orderkey % 900 + 1 AS n, o_custkey % 900 + 1 AS m, o_custkey % 6 >= 4 AS far FROM orders),
e AS (SELECT text_id, 0 AS ord, '323AC0000000131' AS law, n AS num FROM x WHERE t IN (0, 5, 6)
  UNION ALL SELECT text_id, 1, '323AC0000000131', m FROM x WHERE t = 6
  UNION ALL SELECT text_id, 1, '408AC0000000109', m FROM x WHERE t IN (2, 5, 10)
  UNION ALL SELECT text_id, 0, '408AC0000000109', m FROM x WHERE t = 3 AND far
  UNION ALL SELECT text_id, 0, '408AC0000000109', n FROM x WHERE t IN (7, 10, 11, 12, 13, 14)
  UNION ALL SELECT text_id, 1, '408AC0000000109', m FROM x WHERE t = 14
  UNION ALL SELECT text_id, 2, '323AC0000000131', n FROM x WHERE t = 12)
SELECT text_id, ord, 'JPLAW:' || law || '#main#' || num AS "to", '第' || {_kanji('num')} || '条' AS evidence FROM e""",
    "q_law_pages": """WITH f AS (SELECT c_nationkey AS nat, '法' || c_nationkey AS law_name, c_custkey AS k, c_custkey % 5 AS p, CASE WHEN c_custkey % 2 = 0 THEN 'H' ELSE 'S' END AS era, c_custkey % 4 + 1 AS y FROM customer),
plain AS (SELECT law_name, p, count(*) AS n, string_agg('- [[' || CASE p WHEN 0 THEN '本文' WHEN 2 THEN '附則' WHEN 3 THEN '附則/制定時附則' ELSE '附則/init_1' END || '/第' || k || '条.md|第' || k || '条]]', chr(10) ORDER BY k) AS body FROM f WHERE p <> 1 GROUP BY ALL),
one AS (SELECT law_name, era, y, min(k) AS k, count(*) AS n, any_value(nat) AS nat FROM f WHERE p = 1 GROUP BY law_name, era, y),
amended AS (SELECT law_name, count(*) AS n, string_agg('- [[附則/改正法/' || era || y || '_L' || (nat + 1) || '/第' || k || '条.md|' || CASE era WHEN 'H' THEN '平成' ELSE '昭和' END || y || '年法律第' || (nat + 1) || '号]]' || CASE WHEN n > 1 THEN ' (' || n || '条)' ELSE '' END, chr(10) ORDER BY era, y) AS body FROM one GROUP BY law_name),
parts AS (SELECT law_name, p, CASE p WHEN 0 THEN '## 本則（全' || n || '条）' WHEN 2 THEN '### 現行附則' WHEN 3 THEN '### 制定時附則（全' || n || '条）' ELSE '### 制定時附則2（全' || n || '条）' END || chr(10) || chr(10) || body AS part FROM plain
  UNION ALL SELECT law_name, 1, '## 附則（改正法: ' || n || '件）' || chr(10) || chr(10) || body FROM amended)
SELECT law_name, string_agg(part, chr(10) || chr(10) ORDER BY p) AS page FROM parts GROUP BY law_name""",
    "q_rename_chains": f"WITH {_RENAMES} SELECT * FROM ends",
    "q_rename_aliases": f"WITH {_RENAMES} SELECT new AS name, string_agg(old, ',' ORDER BY old) AS aliases FROM moved GROUP BY new",
    "q_renamed_links": f"""WITH {_RENAMES} SELECT c_custkey, 'laws/' || (c_custkey % 20) || '/c' || c_custkey || '.md' AS path,
  'a [[' || replace(coalesce(na, a), '.md', '') || '|' || c_name || ']] b [[' || coalesce(nb, b) || '#x|y]]' || chr(10) || 'c [[' || coalesce(replace(nc, '.md', ''), 'v' || (c_custkey % 3)) || ']] d [[https://e.f]]' AS body,
  CAST((na IS NOT NULL) AS INT) + CAST((nb IS NOT NULL) AS INT) + CAST((nc IS NOT NULL) AS INT) AS n_changed FROM l WHERE c_custkey > 0""",
    "q_rename_check": f"""WITH {_RENAMES}, t AS (SELECT unnest([a, b, c]) AS was, unnest([coalesce(na, a), coalesce(nb, b), coalesce(nc, c)]) AS is_now FROM l),
f AS (SELECT 'laws/' || g || '/v5.md' AS path FROM p WHERE v = 5)
SELECT 'before' AS run, count(*) AS n_links, count(*) FILTER (WHERE was NOT IN (SELECT path FROM f)) AS n_broken FROM t
UNION ALL SELECT 'after', count(*), count(*) FILTER (WHERE is_now NOT IN (SELECT path FROM f)) FROM t""",
    "q_incremental": """SELECT 'o/' || o_orderkey || '.md' AS path, o_orderpriority || CASE WHEN o_orderkey % 7 = 0 THEN '!' ELSE '' END AS body, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS run FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL SELECT 'n/' || o_orderkey || '.md', o_orderstatus, 2 FROM orders WHERE o_orderkey % 13 = 0""",
    "q_incremental_counts": """SELECT 1 AS run, count(*) AS new, 0 AS changed, 0 AS same, 0 AS deleted FROM orders
UNION ALL SELECT 2, count(*) FILTER (WHERE o_orderkey % 13 = 0), count(*) FILTER (WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0), count(*) FILTER (WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0), count(*) FILTER (WHERE o_orderkey % 10 = 0) FROM orders
UNION ALL SELECT 3, 0, 0, count(*) FILTER (WHERE o_orderkey % 10 <> 0) + count(*) FILTER (WHERE o_orderkey % 13 = 0), 0 FROM orders""",
    "q_read_through": """SELECT 'laws/' || p_partkey AS request, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 5 > 0 THEN CAST(p_partkey AS VARCHAR) END AS id FROM part""",
    "q_asked_summaries": """SELECT c_custkey, '本文' || chr(10) || c_name || ':' || c_custkey || CASE WHEN c_custkey % 10 = 7 THEN '' ELSE chr(10) || chr(10) || '## AI要約' || chr(10) || reverse(c_name || ':' || c_custkey) || chr(10) END AS body, CASE WHEN c_custkey % 10 = 7 THEN 2 ELSE 1 END AS n_asked FROM customer""",
    "q_corpus_folders": """SELECT '法' || (p_partkey % 90) AS law_name, count(*) AS n_files, min(CASE WHEN p_partkey % 4 = 0 THEN '/vault/laws/法' || (p_partkey % 90) || '/n' || (p_partkey % 7) || '.md' END) AS law_file
FROM part WHERE p_partkey % 9 <> 0 GROUP BY ALL""",
    "q_run_report": """SELECT CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS status, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS error, count(*) AS n, min(o_orderkey) AS first_target FROM orders GROUP BY ALL""",
    "q_edge_v2": f"""WITH {_EDGES} SELECT 'refs' AS type, CASE WHEN kind IS NULL THEN 'internal' ELSE 'external' END AS relation, split_part("from", '#', 1) AS law, count(*) AS n, count(DISTINCT "to") AS targets FROM edges GROUP BY ALL""",
    "q_kanji_roundtrip": "SELECT l_orderkey, l_linenumber, l_orderkey % 9999 + 1 AS parsed FROM lineitem",
    "q_kanji_concat": "SELECT o_orderkey, o_orderkey % 1000 AS number, CAST(o_orderkey % 1000 AS VARCHAR) AS digits FROM orders",
    "q_article_names": f"""WITH {_ARTICLES} SELECT pos, {_NAME} AS name, CASE WHEN pos % 2 = 0 THEN '附則' ELSE '' END || {_NAME} AS file, '第' || (pos // 8 + 1) || '条から第' || (pos // 8 + 4) || '条まで' AS span FROM articles""",
    "q_article_sort": f"""WITH {_ARTICLES} SELECT pos, law_name, row_number() OVER (PARTITION BY law_name ORDER BY main, sub, pos) AS rank, CAST(main AS INT) AS main, CAST(sub AS INT) AS sub FROM articles""",
    "q_amendment_key": f"""WITH k AS (SELECT o_orderkey, o_orderkey % 2 = 0 AS heisei, CAST(year(o_orderdate) - 1988 AS VARCHAR) AS y, CAST(o_orderkey % 300 + 1 AS VARCHAR) AS n FROM orders)
SELECT o_orderkey, CASE WHEN heisei THEN 'H' ELSE 'R' END || y || '_L' || n AS key, CASE WHEN heisei THEN '平成' ELSE '令和' END || y || '年法律第' || n || '号' AS title, CASE WHEN heisei THEN 'H' ELSE 'R' END || y || '_L' || n AS of_path FROM k""",
    "q_chapter_names": f"""WITH x AS (SELECT p_partkey, p_size * 5 AS num, p_partkey % 3 = 0 AS titled FROM part)
SELECT p_partkey, CASE WHEN titled OR (num >= 100 AND num % 10 <> 0) THEN {_BRANCH('章')} ELSE '第' || num || '章' END AS chapter, CASE WHEN titled THEN {_BRANCH('節')} ELSE '第' || num || '節' END AS section,
  CASE WHEN num >= 100 OR (titled AND num % 10 > 0) THEN {_BRANCH('章')} ELSE '第' || num || '章' END AS old_chapter, CASE WHEN titled AND num % 10 > 0 THEN {_BRANCH('節')} ELSE '第' || num || '節' END AS old_section FROM x""",
    "q_sanitize": """SELECT page_id, regexp_replace(regexp_replace(trim(regexp_replace(' ..' || url || '. ', '[\\\\/*?:"<>|]', '_', 'g')), '^\\.+', ''), '\\.+$', '') AS name FROM pages""",
    "q_link_targets": """SELECT page_id, CAST(NULL AS VARCHAR) AS web, 'laws/p' || page_id AS target, 'a text b plain' AS plain, CAST(2 AS BIGINT) AS n_links FROM pages""",
    "q_containment": f"WITH {_ARTICLES}, {_CONTAINS} SELECT * FROM contained",
    "q_chapter_rollup": f"""WITH {_ARTICLES} SELECT law_id, chapter_num, arg_min(chapter_title, pos) AS chapter_title, string_agg(article_num, ',' ORDER BY pos) AS article_nums, count(*) AS n_articles, count(DISTINCT section_num) AS section_count FROM articles GROUP BY law_id, chapter_num""",
    "q_section_rollup": f"""WITH {_ARTICLES} SELECT law_id, chapter_num, section_num, arg_min(section_title, pos) FILTER (WHERE section_title IS NOT NULL) AS section_title, string_agg(node_id, ',' ORDER BY pos) AS node_ids FROM articles WHERE section_num IS NOT NULL GROUP BY ALL""",
    "q_structure_nodes": f"""WITH {_ARTICLES}, ct AS (SELECT law_id, law_name, chapter_num, arg_min(chapter_title, pos) AS title, string_agg(node_id, ',' ORDER BY pos) AS ids,
    string_agg('- [[laws/' || law_name || '/本文/' || {_NAME} || '.md|' || {_NAME} || ' ' || heading || ']]' || chr(10), '' ORDER BY pos) AS items FROM articles GROUP BY ALL),
c AS (SELECT *, CASE WHEN contains(title, '章の') THEN '第' || (chapter_num // 10) || '章の' || (chapter_num % 10) ELSE '第' || chapter_num || '章' END AS name FROM ct),
st AS (SELECT law_id, law_name, chapter_num, section_num, arg_min(section_title, pos) FILTER (WHERE section_title IS NOT NULL) AS title, string_agg(node_id, ',' ORDER BY pos) AS ids,
    string_agg('- [[laws/' || law_name || '/本文/' || {_NAME} || '.md|' || {_NAME} || ']]' || chr(10), '' ORDER BY pos) AS items FROM articles WHERE section_num IS NOT NULL GROUP BY ALL),
s AS (SELECT st.*, c.name AS chapter, c.title AS chapter_title, CASE WHEN st.title IS NOT NULL THEN '第' || (section_num // 10) || '節の' || (section_num % 10) ELSE '第' || section_num || '節' END AS name FROM st JOIN c USING (law_id, chapter_num)),
l AS (SELECT law_id, chapter_num, count(*) AS n, string_agg('- [[laws/' || law_name || '/節/' || chapter || name || '.md|' || name || coalesce(' ' || title, '') || ']]' || chr(10), '' ORDER BY section_num) AS items FROM s GROUP BY ALL)
SELECT 'JPLAW:' || c.law_id || '#chapter#' || c.chapter_num AS id, 'chapter' AS type, '[[laws/' || law_name || '/' || law_name || ']]' AS parent, 'laws/' || law_name || '/章/' || name || '.md' AS path,
  '# ' || name || ' ' || title || chr(10) || chr(10) || coalesce('## この章の節' || chr(10) || chr(10) || l.items || chr(10), '') || '## この章の条文' || chr(10) || chr(10) || c.items AS body, CAST(coalesce(n, 0) AS INT) AS section_count, ids AS article_ids, law_name || ',kind/chapter' AS tags
FROM c LEFT JOIN l ON l.law_id = c.law_id AND l.chapter_num = c.chapter_num
UNION ALL SELECT 'JPLAW:' || law_id || '#chapter#' || chapter_num || '#section#' || section_num, 'section', '[[laws/' || law_name || '/章/' || chapter || ']]', 'laws/' || law_name || '/節/' || chapter || name || '.md',
  '# ' || chapter || ' ' || chapter_title || ' ' || name || coalesce(' ' || title, '') || chr(10) || chr(10) || '## この節の条文' || chr(10) || chr(10) || items, 0, ids, law_name || ',kind/section' FROM s""",
    "q_article_front": f"""WITH {_ARTICLES}, x AS (SELECT *, pos % 13 = 0 AS su, pos % 26 = 0 AS fr, pos % 26 = 0 AND pos % 52 <> 0 AS am, '平成' || (pos % 9 + 1) || '年六月法律第' || (pos % 90 + 1) || '号' AS t,
  CASE WHEN pos % 5 = 0 THEN '第' || (chapter_num // 10) || '章の' || (chapter_num % 10) ELSE '第' || chapter_num || '章' END AS c, CASE WHEN pos % 4 = 0 THEN '第' || (section_num // 10) || '節の' || (section_num % 10) ELSE '第' || section_num || '節' END AS s,
  CASE WHEN pos % 26 = 0 THEN 'amendment_fragment' WHEN pos % 13 = 0 THEN 'supplement' ELSE 'article' END AS kind FROM articles)
SELECT node_id AS id, kind AS type, '[[laws/' || law_name || '/' || CASE WHEN su THEN law_name WHEN section_num IS NOT NULL THEN '節/' || c || s ELSE '章/' || c END || ']]' AS parent, law_name || ',kind/' || kind AS tags,
  CASE WHEN pos % 3 = 0 THEN TRUE END AS has_proviso, CASE WHEN am THEN 'amendment' END AS suppl_kind, CASE WHEN am THEN 'H' || (pos % 9 + 1) || '_L' || (pos % 90 + 1) END AS amendment_law_id, CASE WHEN am THEN t END AS amendment_law_title,
  CASE WHEN am THEN 'partial' END AS scope, CASE WHEN am THEN law_name END AS parent_law_name FROM x""",
    "q_visible_files": """WITH f AS (SELECT c_custkey, c_nationkey, 'laws/x' || c_nationkey || '/' || c_custkey || '.md' AS path FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0)
SELECT path, 'prefix' AS scan FROM f WHERE c_nationkey = 3 UNION ALL SELECT path, 'all' FROM f""",
    "q_pending_filters": f"SELECT event_id AS id, 'external_law' AS kind, {_law('user_id % 8')} AS src_law_name FROM events WHERE event_id % 2 = 0 AND user_id % 8 = 1",
    "q_redirect_sources": "SELECT p_partkey AS file_id, '第' || p_partkey || '条.md' AS name FROM part WHERE p_partkey % 4 IN (2, 3) AND p_partkey % 6 <> 0",
    "q_amend_law": """SELECT o_orderkey AS id, o_orderkey % 3 = 0 AND o_orderkey % 12 <> 0 AND o_orderkey % 9 <> 0 AS changed,
  CASE WHEN o_orderkey % 12 = 0 THEN 'k' WHEN o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 THEN 'H' || (o_orderkey % 9 + 1) || '_L' || o_custkey END AS normalized_id,
  CASE WHEN o_orderkey % 12 = 0 THEN 'full' WHEN o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 THEN 'partial' END AS scope, CASE WHEN o_orderkey % 12 = 0 THEN 'y' WHEN o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 THEN o_orderstatus END AS parent_law_name FROM orders""",
    "q_parent": f"""WITH {_ARTICLES}, named AS (SELECT *, CASE WHEN pos % 5 = 0 THEN '第' || (chapter_num // 10) || '章の' || (chapter_num % 10) ELSE '第' || chapter_num || '章' END AS c, CASE WHEN pos % 4 = 0 THEN '第' || (section_num // 10) || '節の' || (section_num % 10) ELSE '第' || section_num || '節' END AS s FROM articles)
SELECT pos, '[[laws/' || law_name || '/' || CASE WHEN pos % 13 = 0 THEN law_name WHEN section_num IS NOT NULL THEN '節/' || c || s ELSE '章/' || c END || ']]' AS parent FROM named""",
    "q_resolved_parent": f"""WITH {_ARTICLES}, f AS (SELECT {_law('s_suppkey % 8')} AS law_name, '第' || (s_suppkey % 12 + 1) || '章' AS c, '第' || (s_suppkey % 2 + 1) || '節' AS s, s_suppkey FROM supplier),
x AS (SELECT pos, law_name, '第' || chapter_num || '章' AS c, '第' || section_num || '節' AS s FROM articles)
SELECT pos, CASE WHEN hs THEN '[[laws/' || law_name || '/節/' || c || s || ']]' WHEN hc THEN '[[laws/' || law_name || '/章/' || c || ']]' ELSE '[[laws/' || law_name || '/' || law_name || ']]' END AS new_parent, CASE WHEN hs THEN 'section' WHEN hc THEN 'chapter' ELSE 'law' END AS resolution
FROM (SELECT x.*, coalesce(EXISTS (SELECT 1 FROM f WHERE f.law_name = x.law_name AND f.s_suppkey % 3 <> 0 AND f.c || f.s = x.c || x.s), false) AS hs, EXISTS (SELECT 1 FROM f WHERE f.law_name = x.law_name AND f.s_suppkey % 5 <> 0 AND f.c = x.c) AS hc FROM x)""",
    "q_refs_in_chapter": f"""WITH {_ARTICLES} SELECT 'JPLAW:' || a.law_id || '#chapter#' || a.chapter_num AS "group", count(*) AS n, count(DISTINCT b.node_id) AS targets FROM lineitem JOIN articles a ON a.pos = l_partkey JOIN articles b ON b.pos = l_suppkey WHERE a.law_id = b.law_id AND a.chapter_num = b.chapter_num GROUP BY ALL""",
    "q_chapter_lookup": f"""WITH {_ARTICLES}, {_CONTAINS} SELECT source, target, 'exact' AS how FROM contained WHERE relation = 'chapter_contains_article' AND source = 'JPLAW:129AC0000000089#chapter#1'
UNION ALL SELECT source, target, 'contains' FROM contained WHERE relation = 'chapter_contains_article' AND source LIKE '%JPLAW:129AC0000000089#chapter#1%'""",
    "q_chapter_index": f"""WITH {_ARTICLES} SELECT 'JPLAW:' || law_id || '#chapter#' || chapter_num AS source, chapter_num AS chapter, count(*) AS n_articles, string_agg(node_id, ',' ORDER BY node_id) AS articles FROM articles GROUP BY ALL""",
    "q_toc": """WITH f AS (SELECT n_name AS law_name, CASE WHEN c_custkey % 4 = 0 THEN '附則/改正法/H' || (c_custkey % 3 + 1) || '_L1' ELSE '本文' END AS folder, c_custkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT law_name, folder, count(*) AS n_files, '第' || min(k) || '条.md' AS first_file, CASE WHEN folder = '本文' THEN string_agg('- [[本文/第' || k || '条.md|第' || k || '条]]', chr(10) ORDER BY k)
  ELSE '- [[' || folder || '/第' || min(k) || '条.md|' || split_part(folder, '/', 3) || ']]' || CASE WHEN count(*) > 1 THEN ' (' || count(*) || '条)' ELSE '' END END AS body FROM f GROUP BY law_name, folder""",
    "q_graph_counts": f"""WITH {_EDGES}, {_ARTICLES}, {_CONTAINS} SELECT 'refs' AS type, CASE WHEN kind IS NULL THEN 'internal' ELSE 'external' END AS relation, count(*) AS n, count(*) AS with_evidence FROM edges GROUP BY ALL
UNION ALL SELECT type, relation, count(*), 0 FROM contained GROUP BY ALL""",
    "q_tree_flatten": f"""WITH {_TREES} SELECT law_id, tag, CAST(n AS BIGINT) AS n FROM counts WHERE n > 0""",
    "q_tree_articles": """SELECT CAST(conv_id AS VARCHAR) AS law_id, 'main' AS part, CAST(turn AS VARCHAR) AS article_num, 'JPLAW:' || conv_id || '#main#' || turn AS node_id, role AS heading, CAST(22 AS BIGINT) AS chapter_num, '第二章の二' AS chapter_title,
  CASE WHEN turn % 3 = 0 THEN CAST(3 AS BIGINT) END AS section_num, CASE WHEN turn % 3 = 0 THEN '第三節' END AS section_title, role = 'assistant' AS has_proviso FROM conversations WHERE turn % 5 <> 4
UNION ALL SELECT DISTINCT CAST(conv_id AS VARCHAR), 'suppl', '1', 'JPLAW:' || conv_id || '#suppl#1', NULL, NULL, NULL, NULL, NULL, false FROM conversations""",
    "q_tree_walk": """WITH c AS (SELECT CAST(conv_id AS VARCHAR) AS law_id, turn % 2 AS o, CASE WHEN turn % 3 = 0 THEN 1 ELSE 0 END AS s FROM conversations),
l AS (SELECT law_id, sum(6 + 3 * o) AS every, sum(s * (6 + 3 * o)) AS inner_rows, max(s) AS sectioned FROM c GROUP BY law_id),
n AS (SELECT law_id, x.tag, x.depth + s AS depth, x.below, s AS sec, 1 AS art FROM c, unnest([{'tag': 'Article', 'depth': 3, 'below': 5 + 3 * o}, {'tag': 'ArticleCaption', 'depth': 4, 'below': 1}, {'tag': '#text', 'depth': 5, 'below': 0},
    {'tag': 'Paragraph', 'depth': 4, 'below': 2 + 3 * o}, {'tag': 'Sentence', 'depth': 5, 'below': 1}, {'tag': '#text', 'depth': 6, 'below': 0}]) AS u(x)
  UNION ALL SELECT law_id, tag, depth + s, below, s, 1 FROM c, (VALUES ('Item', 5, 2), ('Sentence', 6, 1), ('#text', 7, 0)) AS v(tag, depth, below) WHERE o = 1
  UNION ALL SELECT law_id, x.tag, x.depth, x.below, 0, 0 FROM l, unnest([{'tag': 'Law', 'depth': 0, 'below': every + 3 * sectioned + 16}, {'tag': 'MainProvision', 'depth': 1, 'below': every + 3 * sectioned + 3}, {'tag': 'Chapter', 'depth': 2, 'below': every + 3 * sectioned + 2}]) AS u(x)
  UNION ALL SELECT law_id, 'Section', 3, inner_rows + 2, 1, 0 FROM l WHERE sectioned = 1
  UNION ALL SELECT law_id, tag, depth, below, 1, 0 FROM l, (VALUES ('SectionTitle', 4, 1), ('#text', 5, 0)) AS v(tag, depth, below) WHERE sectioned = 1
  UNION ALL SELECT law_id, tag, depth, below, 0, art FROM l, (VALUES ('ChapterTitle', 3, 1, 0), ('#text', 4, 0, 0), ('SupplProvision', 1, 4, 0), ('Article', 2, 3, 1), ('Paragraph', 3, 2, 1), ('Sentence', 4, 1, 1), ('#text', 5, 0, 1),
    ('SupplProvision', 1, 6, 0), ('Paragraph', 2, 2, 0), ('Sentence', 3, 1, 0), ('#text', 4, 0, 0), ('Paragraph', 2, 2, 0), ('Sentence', 3, 1, 0), ('#text', 4, 0, 0)) AS v(tag, depth, below, art))
SELECT law_id, tag, count(*) AS n, CAST(max(depth) AS INT) AS depth, CAST(sum(below) AS BIGINT) AS below, CAST(sum(sec) AS BIGINT) AS in_section, CAST(sum(art) AS BIGINT) AS in_article FROM n GROUP BY law_id, tag""",
    "q_tree_provisions": """SELECT DISTINCT CAST(conv_id AS VARCHAR) AS law_id, 'JPLAW:' || conv_id || '#suppl#Provision' AS node_id, CAST(2 AS BIGINT) AS n_paragraphs FROM conversations""",
    "q_tree_text": """WITH c AS (SELECT CAST(conv_id AS VARCHAR) AS law_id, turn, coalesce(text, '') AS text, '項目' || turn AS item FROM conversations),
p AS (SELECT law_id, CASE WHEN turn % 3 = 0 THEN 1 ELSE 0 END AS a, turn AS b, 0 AS c, text || CASE WHEN turn % 2 = 1 THEN item ELSE '' END AS text FROM c
  UNION ALL SELECT law_id, CASE WHEN turn % 3 = 0 THEN 1 ELSE 0 END, turn, 1, item FROM c WHERE turn % 2 = 1
  UNION ALL SELECT law_id, 2, n, 0, x FROM (SELECT DISTINCT law_id FROM c), (VALUES (0, 's1'), (1, 'p1'), (2, 'p2')) AS v(n, x))
SELECT law_id, sha256(string_agg(text, '|' ORDER BY a, b, c)) AS digest, count(*) AS n FROM p GROUP BY law_id""",
    "q_frontmatter": "SELECT doc_id, lang, source, CASE WHEN lang IS NULL THEN 'lang,tier' ELSE 'tier' END AS missing FROM documents",
    "q_nested_front": """SELECT doc_id, true AS same, sha256(coalesce(text, '')) AS note, source AS tag, CASE WHEN doc_id % 3 <> 0 THEN '法: ' || source || ' #' || doc_id END AS title,
  CASE WHEN doc_id % 3 <> 0 THEN n_chars END AS n_chars, CASE WHEN doc_id % 3 <> 0 THEN '- ' || lang END AS law, CASE WHEN doc_id % 3 <> 0 THEN 'yes' END AS name, '# ' || lang || chr(10) || '---' || chr(10) || source AS body FROM documents""",
    "q_amend_front": """SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN '法: ' || source || ' #' || doc_id WHEN doc_id % 2 = 0 THEN lang END AS title,
  CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN source END AS law FROM documents""",
    "q_html_links": f"WITH {_HREFS} SELECT * FROM links",
    "q_broken_links": f"WITH {_HREFS} SELECT * FROM broken WHERE NOT EXISTS (SELECT 1 FROM region WHERE contains(shown, lower(r_name[1:2])))",
    "q_broken_report": f"WITH {_HREFS} SELECT shown, count(*) AS n, least(count(DISTINCT path || ':' || line_no), 5) AS n_samples FROM broken GROUP BY shown ORDER BY n DESC, shown LIMIT 100",
    "q_broken_markdown": f"""WITH {_HREFS}, t AS (SELECT shown, count(*) AS n FROM broken GROUP BY shown), top AS (SELECT * FROM t ORDER BY n DESC, shown LIMIT 100),
s AS (SELECT shown, '  - `' || path || '` (L' || line_no || ')' || chr(10) AS line, path || ':' || line_no AS place FROM (SELECT DISTINCT path, line_no, shown FROM broken) QUALIFY row_number() OVER (PARTITION BY shown ORDER BY path || ':' || line_no) <= 5),
p AS (SELECT n, shown, '### `' || shown || '`' || chr(10) || chr(10) || '- 参照数: ' || n || chr(10) || '- 参照元（最大5件）:' || chr(10) || string_agg(line, '' ORDER BY place) || CASE WHEN n > 5 THEN '  - ... 他 ' || (n - 5) || ' 件' || chr(10) ELSE '' END || chr(10) AS part
  FROM top JOIN s USING (shown) GROUP BY n, shown)
SELECT '# WikiLink整合性チェックレポート' || chr(10) || chr(10) || '## サマリー' || chr(10) || chr(10) || '- **空リンク総数**: ' || (SELECT count(*) FROM broken) || chr(10) || '- **ユニークなターゲット数**: ' || (SELECT count(*) FROM t) || chr(10) || chr(10)
  || '## 空リンク一覧（ターゲット別）' || chr(10) || chr(10) || '※ 上位100件を表示' || chr(10) || chr(10) || string_agg(part, '' ORDER BY n DESC, shown)
  || CASE WHEN (SELECT count(*) FROM t) > 100 THEN chr(10) || '... 他 ' || ((SELECT count(*) FROM t) - 100) || ' ターゲット省略' || chr(10) ELSE '' END AS text FROM p""",
    "q_range_redirect": f'WITH {_RANGES} SELECT link_id, num, start, "end" FROM best',
    "q_stubs": f"""WITH {_RANGES} SELECT law_name, num, array_to_string(list_sort(list(DISTINCT source)), ',') AS referenced_by, count(*) AS n FROM alinks
WHERE from_main AND link_id NOT IN (SELECT link_id FROM best) AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey % 2 = 0 AND p_partkey = num) GROUP BY law_name, num""",
    "q_pending_open": f"""WITH p AS ({_PENDING}), f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts, event_id) = 1)
SELECT id, law, event_id FROM f WHERE id NOT IN (SELECT id FROM p WHERE event_id % 17 = 0)""",
    "q_pending_target": f"""WITH e AS (SELECT event_id, event_id % 60 + 1 AS n, {_law('user_id % 8')} AS src, {_law('event_id % 8')} AS ext, 'H' || (event_id % 5 + 1) || '_L1' AS key, user_id % 8 AS s, event_id % 8 AS x FROM events),
has AS (SELECT e.*, EXISTS (SELECT 1 FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 8 = x AND p_partkey // 8 + 1 = n) AS m,
  EXISTS (SELECT 1 FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 2 = 0 AND p_partkey % 8 = s AND p_partkey // 8 + 1 = n AND p_partkey % 5 = event_id % 5) AS a, EXISTS (SELECT 1 FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 2 = 1 AND p_partkey % 8 = s AND p_partkey // 8 + 1 = n AND p_partkey % 5 = event_id % 5) AS o FROM e)
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 2 = 0 THEN CASE WHEN m THEN 'laws/' || ext || '/本文/第' || n || '条.md' END WHEN a THEN 'laws/' || src || '/附則/改正法/' || key || '/附則第' || n || '条.md' WHEN o THEN 'laws/' || src || '/附則/改正法/' || key || '/第' || n || '条.md' END AS target FROM has""",
    "q_multiset_diff": f"WITH {_DIFF} SELECT * FROM d",
    "q_file_diff": f"WITH {_SNAPSHOTS} SELECT path, status FROM files",
    "q_meta_diff": f"WITH {_SNAPSHOTS} SELECT b.path, 'priority' AS field, b.body AS before, 'x' AS after FROM b JOIN a ON a.path = b.path WHERE a.body = 'x' AND b.body <> 'x'",
    "q_verdict": f"""WITH {_SNAPSHOTS}, {_DIFF}, v AS (SELECT count(*) FILTER (WHERE status = 'missing') AS n_missing, count(*) FILTER (WHERE status = 'changed') AS n_changed, count(*) FILTER (WHERE status IN ('new', 'structure')) AS n_new,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM d WHERE side = 'missing') AS n_edges_missing, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM d WHERE side = 'new') AS n_edges_new FROM files)
SELECT *, n_missing + n_changed + n_edges_missing + n_edges_new = 0 AS compatible FROM v""",
    "q_targets_semi": "SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
    "q_domains": """WITH x AS (SELECT p_partkey, p_name, p_brand, ['民事法', '刑事法', '税法', '社会法', 'その他'] AS d, CAST(p_size % 5 AS INT) + 1 AS i, CAST(p_partkey % 5 AS INT) + 1 AS j FROM part)
SELECT 'JPLAW:' || p_partkey AS node_id, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_brand END AS law_num, trim(p_name || '_') AS folder,
  CASE WHEN p_partkey % 50 = 0 THEN '特別' WHEN p_partkey % 6 = 0 THEN '' WHEN i = j THEN d[i] ELSE least(d[i], d[j]) || ',' || greatest(d[i], d[j]) END AS domain FROM x""",
    "q_best_hit": """WITH h AS (SELECT CAST(o_custkey % 100 AS VARCHAR) AS law_id, o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 1 WHEN o_orderkey % 7 = 0 THEN 2 ELSE 3 END AS priority FROM orders)
SELECT law_id, o_orderkey AS hit_id, priority FROM h QUALIFY row_number() OVER (PARTITION BY law_id ORDER BY priority, o_orderkey) = 1""",
    "q_enriched": """WITH h AS (SELECT o_custkey % 100 AS law, o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 1 WHEN o_orderkey % 7 = 0 THEN 2 ELSE 3 END AS priority FROM orders),
b AS (SELECT *, law % 4 <> 0 AS enriched FROM h QUALIFY row_number() OVER (PARTITION BY law ORDER BY priority, o_orderkey) = 1)
SELECT CAST(law AS VARCHAR) AS law_id, CASE WHEN enriched THEN '第' || law || '号' ELSE '' END AS law_num, enriched, CASE WHEN enriched THEN CAST(o_orderkey AS VARCHAR) END AS hit_id,
  CASE WHEN enriched THEN CASE priority WHEN 1 THEN 'x 第' || law || '号' WHEN 2 THEN '法' || law || ' 改正' ELSE 'other' END END AS title FROM b""",
    "q_parent_changes": """WITH p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 <> 0 THEN '[[laws/法/章/第' || p_size || '章]]' END AS new_parent FROM part)
SELECT 'laws/法/' || k || '.md' AS path, CASE k % 3 WHEN 0 THEN new_parent WHEN 1 THEN '[[laws/法/法]]' END AS old_parent, new_parent,
  CASE WHEN new_parent IS NULL THEN 'error' WHEN k % 3 = 0 THEN 'unchanged' WHEN k % 3 = 1 THEN 'changed' ELSE 'added' END AS status FROM p""",
    "q_status_counts": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL",
    "q_explicit_refs": f"""WITH {_LINES}, l AS (SELECT l_orderkey * 10 + l_linenumber AS text_id, l_linenumber % 3 AS k, l_partkey % 900 + 1 AS n, l_suppkey % 5 + 1 AS a FROM li),
r AS (SELECT text_id, n AS num, '第' || n || '条#第2項' AS target_id, 'absolute' AS type, '第' || {_kanji('n')} || '条第二項' AS original FROM l WHERE k = 0
  UNION ALL SELECT text_id, n, '第' || n || '条#第3項', 'relative', '同条第三項' FROM l WHERE k = 0
  UNION ALL SELECT text_id, a - i, '第' || (a - i) || '条', 'relative', '前三条' FROM l, unnest([1, 2, 3]) AS u(i) WHERE k = 1 AND a - i > 0
  UNION ALL SELECT text_id, a + 1, '第' || (a + 1) || '条#第1項', 'relative', '次条第一項' FROM l WHERE k = 2
  UNION ALL SELECT text_id, n, '第' || n || '条', 'absolute', '第' || n || '条' FROM l WHERE k = 2)
SELECT text_id, target_id, type, original, EXISTS (SELECT 1 FROM part WHERE p_partkey = num) AS resolved FROM r""",
    "q_unlink": """SELECT l_orderkey * 10 + l_linenumber AS text_id, CASE WHEN l_linenumber % 2 = 0 THEN '旧民法[[laws/民法/本文/第' || l_partkey || '条.md|第' || l_partkey || '条]]の' ELSE 'この第' || l_partkey || '条の' END AS body,
  CAST(l_linenumber % 2 AS INT) AS n_unlinked, CAST(1 - l_linenumber % 2 AS INT) AS n_kept FROM lineitem""",
    "q_relink": """SELECT l_orderkey * 10 + l_linenumber AS text_id, '民法の一部。' || CASE WHEN l_linenumber % 2 = 0 THEN '新民法の例による[[laws/民法/本文/第' || l_partkey || '条.md|第' || l_partkey || '条]]' ELSE '附則第' || l_partkey || '条' END AS body,
  CAST(1 - l_linenumber % 2 AS INT) AS n_linked FROM lineitem""",
    "q_mapping": f"""WITH {_ARTICLES} SELECT 'laws/' || law_name || CASE WHEN pos % 3 = 0 THEN '/suppl/' ELSE '/main/' END || 'Article_' || article_num || '.md' AS old_path,
  'laws/' || law_name || CASE WHEN pos % 3 = 0 THEN '/附則/附則' ELSE '/本文/' END || {_NAME} || '.md' AS new_path, true AS changed FROM articles""",
    "q_initial_supplements": """WITH f AS (SELECT DISTINCT s_nationkey AS law_name, CASE WHEN s_suppkey % 3 = 0 THEN 'x' ELSE '' END AS done, CASE WHEN s_suppkey % 3 = 1 THEN 0 WHEN s_suppkey % 3 = 2 THEN s_suppkey % 4 END AS n FROM supplier)
SELECT law_name, 'init_' || n AS old, '制定時附則' || CASE WHEN n > 0 THEN CAST(n + 1 AS VARCHAR) ELSE '' END AS new FROM f WHERE n IS NOT NULL AND NOT (n = 0 AND EXISTS (SELECT 1 FROM f g WHERE g.law_name = f.law_name AND g.done = 'x'))""",
    "q_filled": """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'und' ELSE coalesce(lang, 'und') END AS lang, CASE WHEN doc_id % 4 = 0 THEN 'doc,' || source ELSE source || ',doc' END AS tags,
  CASE WHEN doc_id % 3 = 0 OR lang IS NULL THEN 'lang' ELSE '' END AS added, true AS changed FROM documents""",
    "q_supplement_names": """SELECT s_suppkey AS pos, CASE WHEN s_suppkey % 2 = 0 THEN 'H' || (s_suppkey % 30 + 1) || '_L' || s_suppkey ELSE '制定時附則' || CASE WHEN row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 2 ORDER BY s_suppkey) > 1 THEN CAST(row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 2 ORDER BY s_suppkey) AS VARCHAR) ELSE '' END END AS name FROM supplier""",
    "q_localized_ids": f"""WITH {_ARTICLES} SELECT pos, 'JPLAW:' || law_id || CASE WHEN pos % 3 = 0 THEN '#附則#附則' ELSE '#本文#' END || {_NAME} AS id, true AS stable,
  CASE WHEN pos % 5 = 0 THEN '附則' WHEN pos % 3 = 0 THEN '附則第' || pos || '条から附則第' || (pos + 1) || '条まで' ELSE '第' || pos || '条から第' || (pos + 1) || '条まで' END AS span FROM articles""",
    "q_node_kinds": f"""SELECT p_partkey AS pos, CASE p_partkey % 5 WHEN 0 THEN 'law' WHEN 1 THEN 'article' WHEN 2 THEN 'amendment_fragment' WHEN 3 THEN CASE WHEN p_partkey % 7 = 0 THEN 'amendment_fragment' ELSE 'supplement' END END AS kind, {_law('p_partkey % 8')} AS law FROM part""",
    "q_full_titles": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '某 法' ELSE '昭和' || (o_orderkey % 60 + 1) || '年法律第' || (o_orderkey % 300 + 1) || '号' END AS long, CASE WHEN o_orderkey % 5 = 0 THEN '某_法' ELSE 'S' || (o_orderkey % 60 + 1) || '_L' || (o_orderkey % 300 + 1) END AS short FROM orders""",
    "q_taken_out": f"""WITH {_LINES}, x AS (SELECT 'p' || l_orderkey || '_' || l_linenumber AS path, l_partkey AS k, l_linenumber % 2 = 0 AS gone, '[[laws/少年法/本文/第' || l_partkey || '条.md|第' || l_partkey || '条]]' AS link FROM li)
SELECT path, CASE WHEN gone THEN '少年法第' || k || '条と[[x|y]]、第' || k || '条' ELSE '少年法' || link || 'と[[x|y]]、' || link END AS body, CASE WHEN gone THEN CAST(1 AS BIGINT) END AS n_logged,
  CASE WHEN gone THEN substr(sha1('民法|' || path || '|' || link || '|第' || k || '条'), 1, 16) END AS id FROM x""",
    "q_put_back": f"""WITH {_LINES} SELECT 'p' || l_orderkey || '_' || l_linenumber AS path, 'i' || l_partkey AS id, CASE l_linenumber % 4 WHEN 0 THEN '甲[[laws/x.md|第1条]]乙第1条' WHEN 1 THEN '甲[[laws/x.md|第1条]]乙' WHEN 2 THEN '甲第1条乙[[laws/x.md|第1条]]丙' ELSE 'なし' END AS body,
  CASE l_linenumber % 4 WHEN 0 THEN 'marker' WHEN 1 THEN 'context' WHEN 2 THEN 'context' END AS method FROM li""",
    "q_applied": f"""WITH {_LINES} SELECT l_orderkey * 10 + l_linenumber AS text_id, CASE WHEN l_linenumber % 2 = 0 THEN '[[第' || l_partkey || '条]]' ELSE '第' || l_partkey || '条' END || 'と第' || l_partkey || '条と前条' AS body,
  CAST(1 - l_linenumber % 2 AS INT) AS n_applied, CAST(2 AS BIGINT) AS n_references FROM li""",
    "q_summaries": "SELECT c_nationkey, count(*) FILTER (WHERE c_custkey % 3 = 0) AS done, count(*) AS total, count(*) FILTER (WHERE c_custkey % 3 = 0) * 100 // count(*) AS percent FROM customer GROUP BY c_nationkey",
    "q_amendment_books": f"""WITH {_ARTICLES} SELECT 'H' || (pos % 11 + 1) || '_L1' AS amendment_key, array_to_string(list_sort(list(DISTINCT law_name)), ',') AS laws, count(*) AS n, string_agg(node_id, ',' ORDER BY law_name, node_id) AS node_ids FROM articles WHERE pos % 3 <> 0 GROUP BY pos % 11""",
    "q_reasons": f"""WITH {_LINES} SELECT l_orderkey * 10 + l_linenumber AS text_id, CASE WHEN l_linenumber % 2 = 0 AND l_partkey % 300 <= 196 THEN 'external_law' ELSE 'missing_article' END AS reason, CASE l_linenumber % 3 WHEN 1 THEN 'external_law' ELSE 'unknown' END AS kind,
  CASE l_linenumber % 3 WHEN 0 THEN 'same_law_token' WHEN 1 THEN 'detected_external_law_name_in_context' ELSE 'unclassified' END AS why, CASE WHEN l_linenumber % 3 <> 1 AND l_linenumber % 2 = 0 THEN 'H1_L1' END AS amendment_key FROM li""",
    "q_legacy_names": """SELECT 'laws/x/' || CASE p_partkey % 4 WHEN 0 THEN 'init_' || p_partkey || '/第1条.md' WHEN 1 THEN 'init_' || p_partkey || '.md' ELSE 'a_init_' || p_partkey || '_第' || p_partkey || '条.md' END AS path,
  CASE p_partkey % 4 WHEN 0 THEN 'folder' WHEN 1 THEN 'file' ELSE 'prefixed_file' END AS category, CASE p_partkey % 4 WHEN 0 THEN '第1条' WHEN 1 THEN CAST(p_partkey AS VARCHAR) ELSE '第' || p_partkey || '条' END AS display FROM part WHERE p_partkey % 4 < 3""",
    "q_canonical_ids": f"""SELECT p_partkey AS pos, {_law('p_partkey % 8')} || '_附則第' || p_partkey || '条_H' || (p_partkey % 9 + 1) || '_L1' AS canonical_id, CAST(greatest(p_partkey % 4, 2) AS INT) AS tier FROM part""",
}
