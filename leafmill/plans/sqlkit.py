"""Pieces of DuckDB SQL that several oracles share. Written from the stated semantics, not from the Spark expressions."""

#: Unicode white space and U+001C-U+001F, for use inside brackets.
WSC = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"[{WSC}]"
#: Line ends as one-character separators after CRLF is folded.
ENDS = r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\A{WS}+', ''), '{WS}+\\z', '')"


def rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+\\z', '')"


def file_name(x: str) -> str:
    forbidden = r"""'[\\/:*?"<>|]'"""
    return f"coalesce(nullif({strip(f'''regexp_replace(coalesce({x}, ''), {forbidden}, '_', 'g')''')}, ''), 'untitled')"


def lines(x: str) -> str:
    """Lines without ends; a final end opens no further line."""
    split = f"string_split(regexp_replace({x}, '{ENDS}', chr(10), 'g'), chr(10))"
    return f"(CASE WHEN {split}[-1] = '' THEN {split}[1:-2] ELSE {split} END)"


NODES = """(SELECT tree_id, id, nullif(b.parent_id, '') AS parent_id, b.pos AS pos, b.title AS title, coalesce(b.node_type, 'page') AS node_type, b.slug AS slug
  FROM (SELECT tree_id, id, min({'parent_id': coalesce(parent_id, ''), 'pos': coalesce(pos, 0), 'title': title, 'node_type': node_type, 'slug': slug}) AS b
        FROM page_nodes WHERE id IS NOT NULL AND tree_id IS NOT NULL GROUP BY tree_id, id))"""

#: Pages with Markdown, once each.
PAGES = f"(SELECT DISTINCT page_id, tree_id, markdown FROM fetch_attempts WHERE regexp_matches(markdown, '[^{WSC}]'))"

#: One expression for both engines that puts wiki remains around a page's text, by page number.
WRAPPED = """concat(
  CASE WHEN CAST(page_id AS BIGINT) % 2 = 0 THEN concat('1. [Home](/h)', chr(10), '2. [Area](/a)', chr(10)) ELSE '' END,
  CASE WHEN CAST(page_id AS BIGINT) % 3 = 0 THEN concat('* [E编辑](/e)', chr(10), '+ [S分享](/s) x', chr(10)) ELSE '' END,
  CASE WHEN CAST(page_id AS BIGINT) % 5 < 2 THEN concat('[跳到banner的尾部](#b) and [回到标题开始](#t)', chr(10)) ELSE '' END,
  CASE WHEN CAST(page_id AS BIGINT) % 4 = 0 THEN concat('* [Tool](#)', chr(10)) ELSE '' END,
  CASE WHEN CAST(page_id AS BIGINT) % 7 = 0 THEN '[![用户图标: 添加头像](/i.png)](/u) ' ELSE '' END,
  CASE WHEN CAST(page_id AS BIGINT) % 3 < 2 THEN concat(chr(10), 'http://wiki.example.com/download/attachments/', page_id, '/image1.png', chr(10), '  http://wiki.example.com/download/attachments/', page_id, '/notes%20a.pdf  ', chr(10)) ELSE '' END,
  CASE WHEN CAST(page_id AS BIGINT) % 3 = 1 THEN concat('See http://wiki.example.com/pages/viewpage.action?pageId=', page_id, ' and http://wiki.example.com/pages/viewpage.action?pageId=77', chr(10)) ELSE '' END,
  markdown)"""

#: The first successful attempt of each page, or its last error.
_GOOD = f"regexp_matches(markdown, '[^{WSC}]')"
FALLBACK = f"""(SELECT page_id, tree_id, coalesce(w.title, 'page_' || page_id) AS title, w.markdown AS markdown, CASE WHEN w IS NULL THEN l ELSE '' END AS error, coalesce(w.strategy_idx, last_idx) AS strategy_idx
  FROM (SELECT page_id, tree_id, arg_min({{'title': title, 'markdown': markdown, 'strategy_idx': strategy_idx}}, strategy_idx) FILTER ({_GOOD}) AS w, max(strategy_idx) AS last_idx, arg_max(coalesce(error, ''), {{'i': strategy_idx, 'e': coalesce(error, '')}}) AS l
        FROM fetch_attempts WHERE page_id IS NOT NULL GROUP BY page_id, tree_id))"""
